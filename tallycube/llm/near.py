"""N-gram Jaccard join by PartEnum signatures.

Two sets of shingles with Jaccard similarity of at least t differ in at most k = 2u(1-t)/(1+t) members, u being the
larger size their band allows. The domain of shingles is cut into n1 parts by hash, each into three; as k < 2 n1, one
of the parts holds at most one difference, so the two sets agree on two of its three pieces. Each set therefore has a
signature for each part and each two of its pieces, and similar sets of a band share one. A set near the upper end of
its band takes part in the next band as well.

Two sets could agree on nothing but empty pieces. Where that is not out of the question (few parts, or many empty
pieces), a set adds its prefix tokens, of which similar sets share one in any case.

Equal sets are one node. Each node is compared with the first ones of its buckets; then, in buckets that still have members
of two components, those with each other. Sizes and sketches rule out most pairs; the rest are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tallycube.llm.common import bit_filter, fresh, passes, quoted, shielded, slices, texts_of, tidy, written
from tallycube.llm.components import components
from tallycube.llm.shingles import VISIBLE, Words, mix

SIZE = 4
SIMILARITY = 85  # percent
BAND = 1.4  # ratio of the sizes of a band
FEW_PARTS = 16
MANY_EMPTY = 0.05
FILTER_BITS = 24  # 2 MB: marks documents whose sets are read again
PER_TASK = 1_000_000  # signatures dealt to a task

DOCS = "doc_id long, text_hash long, n_shingles long, node long"
BUNDLES = "part long, nodes binary, signatures binary"
SHARED = "signature long, first long, node long"
SETS = "node long, size long, sketch binary, shingles array<long>"
SKETCHED = "a long, b long"
TOLD = 8  # signatures by which a pair that shares many is told once
CHUNK = 200_000  # bytes whose words are hashed at once
PAIRS = 200_000  # pairs of members whose sketches are compared at once
BLOCK = 2000  # members of a bucket that a task compares with each other, or with as many others


class Bands:
    """Bands of set sizes and the largest difference of similar sets within each."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.high = [1], [1]

    def of(self, n: int) -> int:
        while self.high[-1] < n:
            self.low.append(self.high[-1] + 1)
            self.high.append(max(self.low[-1], int(self.low[-1] * BAND)))
        return int(np.searchsorted(self.high, n))

    def tags(self, n: int) -> list[tuple[int, int]]:
        """(band, k) for the bands that a set of n members takes part in; bands without a difference need none."""
        largest = n * 100 // self.percent
        bands = sorted({self.of(n), self.of(largest)})
        ks = [(b, 2 * self.high[b] * (100 - self.percent) // (100 + self.percent)) for b in bands]
        return [(b, k) for b, k in ks if k > 0]


def sets_of(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than `size` make one shingle, no words none."""
    out: list[np.ndarray] = []
    first = length = 0
    for k, text in enumerate(texts):
        length += len(text)
        if length >= CHUNK or k == len(texts) - 1:
            out += _sets_in(texts[first : k + 1], size)
            first, length = k + 1, 0
    return out


def _sets_in(texts: list[bytes], size: int) -> list[np.ndarray]:
    w = Words(texts, VISIBLE)
    hashes, places = w.runs(size)
    bounds = np.searchsorted(places, w.first)
    counts = np.diff(w.first)
    out = [np.unique(hashes[bounds[k] : bounds[k + 1]]) for k in range(len(texts))]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes, places = w.runs(n)
            for k in short.tolist():
                out[k] = hashes[np.searchsorted(places, w.first[k]) :][:1]
    return out


def node_of(shingles: np.ndarray) -> int:
    """One number for a set: equal sets have the same."""
    both = mix(shingles.sum(dtype=np.uint64, keepdims=True) + mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))))
    return int(both.view(np.int64)[0])


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of a set."""
    n = len(shingles)
    out = []
    for band, k in bands.tags(n):
        parts = (k + 2) // 2
        part = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cell = (part * np.uint64(3) + (shingles & np.uint64(0xFFFFFFFF)) % np.uint64(3)).astype(np.int64)
        sums = np.zeros(3 * parts, np.uint64)
        np.add.at(sums, cell, mix(shingles + np.uint64(band + 1)))
        filled = np.bincount(cell, minlength=3 * parts) > 0
        sums, filled = sums.reshape(-1, 3), filled.reshape(-1, 3)
        pairs = np.stack([sums[:, 0] + sums[:, 1], sums[:, 0] + sums[:, 2], sums[:, 1] + sums[:, 2]], 1)
        some = np.stack([filled[:, 0] | filled[:, 1], filled[:, 0] | filled[:, 2], filled[:, 1] | filled[:, 2]], 1).ravel()
        salt = np.arange(3 * parts, dtype=np.uint64) + (np.uint64(band) << np.uint64(40))
        out.append(mix(pairs.ravel() + mix(salt + np.uint64(1)))[some])
        empty = 1 - some.mean()
        if empty > 0 and (parts < FEW_PARTS or empty > MANY_EMPTY):
            prefix = n - -(-bands.percent * n // 100) + 1
            out.append(mix(shingles[:prefix] ^ mix(np.full(1, band + (1 << 20), np.uint64))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of how many members fall on each bit, of at least two bits for each member. Two sets differ in at least
    as many members as their sketches differ in bits; a sketch is halved by folding one half onto the other."""
    bits = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    at = mix(shingles + np.uint64(17)) & np.uint64(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


def folded(a: np.ndarray, words: int) -> np.ndarray:
    while a.shape[-1] > words:
        half = a.shape[-1] // 2
        a = a[..., :half] ^ a[..., half:]
    return a


def may_be_similar(differing: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of `sizes` members together can be similar enough if they differ in `differing` members at least."""
    return differing * (100 + percent) <= sizes * (100 - percent)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


@tidy
def _nodes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in fresh(batches):
        ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for at, texts in slices(batch.column(1)):
            sets = sets_of(texts, size)
            n = [len(s) for s in sets]
            nodes = [node_of(s) if len(s) else None for s in sets]
            yield _batch(DOCS, ids[at : at + len(texts)], keys[at : at + len(texts)], n, nodes)


@tidy
def _bundles(batches: Iterator[pa.RecordBatch], size: int, percent: int, parts: int) -> Iterator[pa.RecordBatch]:
    bands = Bands(percent)
    for batch in fresh(batches):
        for _, texts in slices(batch.column(0)):
            nodes, found = [], []
            for s in sets_of(texts, size):
                if len(s):
                    found.append(signatures(s, bands))
                    nodes.append(np.full(len(found[-1]), node_of(s), np.int64))
            if not found:
                continue
            signature, node = np.concatenate(found), np.concatenate(nodes)
            part = (((signature >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cuts))
            yield _batch(
                BUNDLES,
                some,
                [node[order[cuts[p] : cuts[p + 1]]].tobytes() for p in some],
                [signature[order[cuts[p] : cuts[p + 1]]].tobytes() for p in some],
            )


@tidy
def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (signature, first, node) for the nodes that share a signature with a smaller one, the first.

    One row for each signature is kept in memory, and the others are passed on, so that a frequent signature takes no
    more room than a rare one.
    """
    kept = np.zeros(0, np.int64), np.zeros(0, np.int64)
    some: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def compact() -> pa.RecordBatch:
        nonlocal kept
        signature = np.concatenate([kept[0], *(s for s, _ in some)])
        node = np.concatenate([kept[1], *(n for _, n in some)])
        order = np.lexsort((node, signature))
        signature, node = signature[order], node[order]
        head = np.ones(len(signature), bool)
        head[1:] = signature[1:] != signature[:-1]
        first = node[np.flatnonzero(head)][np.cumsum(head) - 1] if len(node) else node
        other = first != node
        kept = signature[head], node[head]
        return _batch(SHARED, signature[other], first[other], node[other])

    for batch in fresh(batches):
        for nodes, signatures_ in zip(texts_of(batch.column(1)), texts_of(batch.column(2)), strict=True):
            some.append((np.frombuffer(signatures_, np.int64), np.frombuffer(nodes, np.int64)))
            size += len(some[-1][0])
        if size > PER_TASK:
            yield compact()
            some, size = [], 0
    yield compact()


@tidy
def _sets(batches: Iterator[pa.RecordBatch], shared, size: int) -> Iterator[pa.RecordBatch]:
    for batch in fresh(batches):
        hashes = np.array(batch.column(1).to_pylist(), np.int64).view(np.uint64)
        chosen = np.flatnonzero(passes(shared.value, hashes))
        for _, texts in slices(batch.column(0).take(pa.array(chosen))):
            sets = [s for s in sets_of(texts, size) if len(s)]
            yield _batch(SETS, [node_of(s) for s in sets], list(map(len, sets)), [sketch(s).tobytes() for s in sets], [s.view(np.int64) for s in sets])


@tidy
def _by_sketch(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) that their sketches do not rule out."""
    for batch in fresh(batches):
        a, b, na, nb = (batch.column(k).to_numpy() for k in range(4))
        sa, sb = ([np.frombuffer(x, np.uint64) for x in texts_of(batch.column(k))] for k in (4, 5))
        words = [min(len(x), len(y)) for x, y in zip(sa, sb, strict=True)]
        apart = np.array([int(np.bitwise_count(folded(x, w) ^ folded(y, w)).sum()) for x, y, w in zip(sa, sb, words, strict=True)], np.int64)
        kept = may_be_similar(apart, na + nb, percent) if len(a) else np.zeros(0, bool)
        yield _batch(SKETCHED, a[kept], b[kept])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: sizes first, then sketches, then the sets themselves."""
    brief = lambda c: sets.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    sized = pairs.join(brief("a"), "a").join(brief("b"), "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    left = sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(lambda x: _by_sketch(x, percent), SKETCHED)
    return _verified(left, sets, percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    whole = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}"))
    n = F.size("of_a") + F.size("of_b")
    both = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(whole("b"), "b").join(whole("a"), "a").filter(100 * both >= percent * (n - both)).select("a", "b")


@tidy
def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in each bucket that sizes and sketches do not rule out. Rows come sorted by bucket.

    A pair may share hundreds of buckets. Each node knows the smallest signatures of its buckets; where two have one of
    those in common, the pair is told in the bucket of the smallest such signature only.
    """
    held: list[tuple] = []
    bucket = None

    def pairs() -> Iterator[pa.RecordBatch]:
        node, root, size, side, same = (np.array(c) for c in zip(*(r[:5] for r in held), strict=True))
        sketches = [np.frombuffer(r[5], np.uint64) for r in held]
        smallest = np.array([[*r[6], *[-k] * (TOLD - len(r[6]))] for k, r in enumerate(held, 1)], np.int64)
        known = np.array([[True] * len(r[6]) + [False] * (TOLD - len(r[6])) for r in held])
        words = min(map(len, sketches))
        bits = np.stack([folded(x, words) for x in sketches])
        step = max(1, 2_000_000 // (len(held) * words))
        for at in range(0, len(held), step):
            rows = slice(at, min(len(held), at + step))
            small = np.minimum(size[rows, None], size[None]) * 100 >= percent * np.maximum(size[rows, None], size[None])
            ask = small & (root[rows, None] != root[None]) & (node[rows, None] < node[None]) & (same[rows, None] | (side[rows, None] != side[None]))
            i, j = np.nonzero(ask)
            for cut in range(0, len(i), PAIRS):
                x, y = i[cut : cut + PAIRS] + at, j[cut : cut + PAIRS]
                apart = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
                kept = may_be_similar(apart, size[x] + size[y], percent)
                x, y = x[kept], y[kept]
                both = (smallest[x][:, :, None] == smallest[y][:, None, :]) & known[x][:, :, None] & known[y][:, None, :]
                first = np.where(both.any(2), smallest[x], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
                here = ~both.any((1, 2)) | (first == bucket[0])
                yield _batch(SKETCHED, node[x[here]], node[y[here]])

    for batch in fresh(batches):
        for signature, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (signature, low, high) != bucket:
                if len(held) > 1:
                    yield from pairs()
                held, bucket = [], (signature, low, high)
            held.append((*row[:4], low == high, *row[4:]))
    if len(held) > 1:
        yield from pairs()


def _left_in_buckets(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in buckets of three members or more, as far as sizes and sketches allow.

    Buckets with the same members count once. A bucket is cut into blocks of about BLOCK members, and each two blocks
    meet in one place, so that no task holds more than two.
    """
    rooted = _rooted(members, roots, "node", "root")
    buckets = rooted.groupBy("signature").agg(
        F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.bit_xor(F.xxhash64("node")).alias("print"), F.min("node").alias("least")
    )
    mixed = buckets.filter("n > 2 and low <> high").groupBy("n", "print", "least").agg(F.min("signature").alias("signature"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    found = written(rooted.join(mixed.select("signature", "n"), "signature"), "mixed")
    told = found.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("signature")), 1, TOLD).alias("told"))
    rows = (
        found.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("signature", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root", "own")
        .join(told.join(sets.select("node", "size", "sketch"), "node"), "node")
        .select("signature", "i", "j", "node", "root", "size", "own", "sketch", "told")
    )
    dealt = rows.repartition("signature", "i", "j").sortWithinPartitions("signature", "i", "j")
    return dealt.mapInArrow(lambda b: _compare(b, percent), SKETCHED).distinct()


def _grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after more links: the components of the links between the roots so far."""
    at = lambda c: links.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")), c, "left")
    links = at("a")
    links = at("b").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    top = components(links)
    moved = roots.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    old = moved.select("node", F.coalesce("top", "root").alias("root"))
    return written(old.unionByName(top.join(roots, "node", "left_anti").select("node", "root")), "roots")


def join_similar(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = SIMILARITY
) -> DataFrame:
    """One row per document: doc_id, text_hash (of the text), n_shingles, component_id, class.

    Two documents are linked when their sets of word shingles have a Jaccard similarity of at least `percent`, and
    `component_id` is the smallest doc_id that links lead to. A text without words, empty or null, is linked with nothing
    and has its own id; `class` names its component (null without words). A null id is never the smallest of others, and stays null where it is alone. Repeated rows have equal
    sets and are one component. Other columns are left out; an empty table gives no rows.
    """
    spark: SparkSession = documents.sparkSession
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    docs = written(source.select("doc_id", "text", "text_hash").mapInArrow(lambda b: _nodes(b, size), DOCS), "nodes")
    total = docs.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(8, -(-total // PER_TASK))
    bundles = source.select("text").mapInArrow(lambda b: _bundles(b, size, percent, parts), BUNDLES).repartition(parts, "part")
    shared = written(bundles.mapInArrow(_shared, SHARED).distinct(), "shared")
    members = shared.select("signature", "node").unionByName(shared.select("signature", F.col("first").alias("node"))).distinct()
    active = members.select("node").distinct()
    chosen = docs.join(active, "node", "left_semi").groupBy("node").agg(F.min(F.struct("text_hash")).alias("x")).select("node", "x.text_hash")
    marked = spark.sparkContext.broadcast(bit_filter(chosen.select("text_hash"), FILTER_BITS))
    sets = written(
        source.select("text", "text_hash").mapInArrow(lambda b: _sets(b, marked, size), SETS).join(active, "node", "left_semi").dropDuplicates(["node"]),
        "sets",
    )
    # Each node is compared with the first ones of its buckets, then what is left in buckets of several components.
    pairs = shared.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    roots = components(written(_linked(pairs, sets, percent), "links"))
    rest = written(_left_in_buckets(members, roots, sets, percent), "pairs")
    roots = _grown(roots, written(_verified(rest, sets, percent), "links"))
    named = docs.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "root", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"), F.col("root").alias("class")
    )


def _rooted(df: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    at = roots.select(F.col("node").alias(column), F.col("root").alias(name))
    return df.join(at, column, "left").withColumn(name, F.coalesce(name, column))


def keep_one(documents: DataFrame, joined: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest id, null ids last. Of a row that is repeated one stays,
    also without an id. Texts without words are in no component, and all stay."""
    rows = joined.filter("class is not null").groupBy("class", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = rows.groupBy("class").agg(F.min(rank).alias("best"))
    ranked = rows.join(best, "class").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), (rank == F.col("best")).alias("first"), "n")
    gone = written(ranked.filter("not first or n > 1"), "gone")

    def one(plain: DataFrame, id_: str, text_: str) -> DataFrame:
        same = F.col(id_).cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.col(text_).cast("string")) == F.col("hash"))
        repeated = plain.join(gone.filter("first"), same, "left_semi").dropDuplicates([id_, text_])
        return plain.join(gone, same, "left_anti").unionByName(repeated)

    return shielded(documents, [], [doc_id, text], one)
