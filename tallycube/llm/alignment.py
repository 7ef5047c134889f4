"""Cross-tokenizer alignment with inverted bitmaps of id pairs.

A text is cut by two tokenizers. Byte offsets where tokens of both end part them into groups; each token of one is linked
to each token of the other in its group. The index has, for each pair of ids, a compressed bitmap of the documents in
which it is linked, and planes with the bits of how often. Bitmaps are kept by chunks of documents; put side by side they
are the bitmap of the corpus, so counts of set bits add up to document counts, and those of the planes to link counts.
Each chunk's postings then go to the counts of their pairs, and what comes back are sums per document.

Both tokenizers cut before a space that follows a letter or another visible character, whatever stands around it. So the
segments between such places are cut apart, and each distinct one only once.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import grown, quoted, ranges, slices, texts_of, written
from tallycube.llm.shingles import BYTE_VALUE, mix, powers

SLICE = 2_000_000  # bytes of text in a chunk; rows are bounded by the batches of the session
ROOM = 250_000  # segments whose cuts a worker remembers, about 80 MB
LARGE = 64  # links of a group from which repeated ids are counted first
PARTS = 16  # parts of the pairs; a document gets one sum back from each
BYTES_PER_TASK = 1_000_000_000  # of text whose postings meet a part of the pairs in one task
PAIRS_HELD = 2_000_000  # pairs whose counts a task keeps before it passes them on

VISIBLE = frozenset(range(0x21, 0x7F))
PIECE_SPACE = "▁".encode()  # stands for a space in the piece model

CHUNKS = (
    "chunk long, local int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "part int, size int, pairs binary, counts binary, lists binary, bits binary, planes binary"
)
COUNTS = "part int, pair long, docs long, links long"
SUMS = "chunk long, locals binary, counts binary, best binary"
SCORES = "chunk long, local int, n_best long, count_sum long"
KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


# segments


def segments_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, owner, hash) of the segments of texts that begin with a space, joined.

    A segment ends before a space that follows a visible ASCII character or a letter of the Latin-1 block, unless only
    spaces come after it.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    visible = (data > 0x20) & (data < 0x7F)
    visible[1:] |= (data[1:] >= 0x80) & (data[:-1] == 0xC3)
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 0x20) & visible[:-1]
    for start, text in zip(bounds.tolist(), texts, strict=False):
        if text.endswith(b" "):
            cut[start + len(text.rstrip(b" ")) : start + len(text)] = False
    cut[bounds[:-1][lengths > 0]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    owner = np.searchsorted(bounds, start, side="right") - 1
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUE[data] * up[: len(data)])])
    value = mix((sums[end] - sums[start]) * down[start] + mix((end - start).astype(np.uint64)))
    return start, end, owner, value


class Cuts:
    """Segments in both tokenizers, in a row: per segment the counts (1 if the tokens do not spell it, tokens of both,
    groups, links), the groups in text form, and the linked pairs of ids (a * 2^32 + b) with how often."""

    def __init__(self) -> None:
        self.counts = np.zeros((1024, 5), np.int64)
        self.told: list[bytes] = []
        self.start = np.zeros(1025, np.int64)
        self.pairs = np.zeros(4096, np.uint64)
        self.times = np.zeros(4096, np.int64)

    def add(self, counts: np.ndarray, told: list[bytes], lengths: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        n, at = len(self.told), self.start[len(self.told)]
        self.counts = grown(self.counts, n + len(told))
        self.start = grown(self.start, n + len(told) + 1)
        self.pairs, self.times = grown(self.pairs, at + len(pairs)), grown(self.times, at + len(pairs))
        self.counts[n : n + len(told)] = counts
        self.start[n + 1 : n + 1 + len(told)] = at + np.cumsum(lengths)
        self.pairs[at : at + len(pairs)], self.times[at : at + len(pairs)] = pairs, times
        self.told += told

    def linked(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of pairs of each of `some` segments, pairs, times)."""
        start, n = self.start[some], self.start[some + 1] - self.start[some]
        at = ranges(start, n)
        return n, self.pairs[at], self.times[at]

    def only(self, some: np.ndarray) -> Cuts:
        kept = Cuts()
        kept.add(self.counts[some], [self.told[k] for k in some.tolist()], *self.linked(some))
        return kept


class Codecs:
    """Both tokenizers, and the cuts of the segments seen so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = byte_level(self.a)
        self.bytes_b = [piece_bytes(self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.lengths_a, self.lengths_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        # An id in text form with what may follow it: nothing, the next id, the other side, the next group.
        self.forms = [b"%d%s" % (k, mark) for k in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in (b"", b",", b"|", b";")]
        self.known: dict[bytes, int] = {}
        self.cuts = Cuts()

    def places(self, segments: list[bytes]) -> np.ndarray:
        """Where the cuts of distinct segments are in `cuts`. At most ROOM are remembered, and those asked for last."""
        missing = [s for s in segments if s not in self.known]
        plain = [s for s in missing if s[-1] in VISIBLE and PIECE_SPACE not in s]
        for some, cut in ((plain, self._cut_joined), ([s for s in missing if s[-1] not in VISIBLE or PIECE_SPACE in s], self._cut)):
            if some:
                first = len(self.cuts.told)
                self.known |= dict(zip(some, range(first, first + len(some)), strict=True))
                self.cuts.add(*cut(some))
        at = np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))
        if len(self.known) > ROOM or len(self.cuts.pairs) > 20 * ROOM:
            self.cuts, at = self.cuts.only(at), np.arange(len(at))
            self.known = dict(zip(segments, range(len(segments)), strict=True)) if len(segments) <= ROOM else {}
        return at

    def _cut_joined(self, segments: list[bytes]) -> tuple:
        """Segments that end in a visible character: one behind the other they are a text that is cut between them."""
        joined = b"".join(segments)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        found = self.a.encode(joined.decode(), add_special_tokens=False).ids, self.b.encode(joined[1:].decode())
        ids, n = [], []
        for some, width, as_bytes in zip(found, (self.lengths_a, self.lengths_b), (self.bytes_a, self.bytes_b), strict=True):
            ids.append(np.array(some, np.int64))
            ends = np.cumsum(width[ids[-1]])
            upto = np.searchsorted(ends, np.cumsum(lengths), side="right")
            if not np.array_equal(ends[upto - 1], np.cumsum(lengths)) or b"".join([as_bytes[k] for k in some]) != joined:
                return self._cut(segments)
            n.append(np.diff(upto, prepend=0))
        return self._align(ids, n, np.ones(len(segments), bool), lengths)

    def _cut(self, segments: list[bytes]) -> tuple:
        texts = [s.decode() for s in segments]
        found = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)  # b adds the space itself
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        n = [np.fromiter(map(len, x), np.int64, len(segments)) for x in found]
        ids = [np.fromiter((k for x in y for k in x), np.int64, int(m.sum())) for y, m in zip(found, n, strict=True)]
        spelt = np.ones(len(segments), bool)
        for tokens, m, width, as_bytes in zip(ids, n, (self.lengths_a, self.lengths_b), (self.bytes_a, self.bytes_b), strict=True):
            owner = np.repeat(np.arange(len(segments)), m)
            spelt &= np.bincount(owner, width[tokens], minlength=len(segments)) == lengths
            some = spelt[owner]
            data = np.frombuffer(b"".join([as_bytes[k] for k in tokens[some].tolist()]), np.uint8)
            want = np.frombuffer(b"".join([s for s, ok in zip(segments, spelt.tolist(), strict=True) if ok]), np.uint8)
            wrong = np.repeat(np.flatnonzero(spelt), lengths[spelt])[data != want]
            spelt[wrong] = False
        for k in range(2):
            some = np.repeat(spelt, n[k])
            ids[k], n[k] = ids[k][some], np.where(spelt, n[k], 0)
        return self._align(ids, n, spelt, np.where(spelt, lengths, 0))

    def _align(self, ids: list[np.ndarray], n: list[np.ndarray], spelt: np.ndarray, lengths: np.ndarray) -> tuple:
        """All segments at once, as their ends are ends of tokens of both."""
        ends = [np.cumsum(width[x]) for x, width in zip(ids, (self.lengths_a, self.lengths_b), strict=True)]
        both = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(both, e) for e in ends]
        size = [np.bincount(g, minlength=len(both)) for g in group]
        segment = np.searchsorted(np.cumsum(lengths), both)
        of_segment = lambda x: np.bincount(segment, x, minlength=len(spelt)).astype(np.int64)
        links = size[0] * size[1]
        counts = np.stack([~spelt, n[0], n[1], of_segment(np.ones(len(both))), of_segment(links)], 1)
        # Text form: the ids of a group, first those of one side, then those of the other.
        of = np.concatenate(group)
        order = np.lexsort((np.repeat([0, 1], [len(g) for g in group]), of))
        last = np.concatenate([np.append(g[1:] != g[:-1], True)[: len(g)] for g in group])
        side = np.repeat([0, 1], [len(g) for g in group])
        mark = np.where(~last, 1, np.where(side == 0, 2, 3))
        closing = np.append(segment[1:] != segment[:-1], True)[: len(segment)]
        mark[(side == 1) & last & closing[of]] = 0
        forms = [self.forms[k] for k in (np.concatenate(ids) * 4 + mark)[order].tolist()]
        cuts = np.concatenate([[0], np.cumsum(n[0] + n[1])]).tolist()
        told = [b"".join(forms[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        # Pairs: of each group, all ids of one side with all of the other; ids that repeat in large groups are counted.
        start = [np.cumsum(x) - x for x in size]
        plain = np.flatnonzero(links <= LARGE)
        across = np.repeat(size[1][plain], size[0][plain])
        left = np.repeat(ranges(start[0][plain], size[0][plain]), across)
        right = ranges(np.repeat(start[1][plain], size[0][plain]), across)
        pairs = [ids[0][left].astype(np.uint64) << np.uint64(32) | ids[1][right].astype(np.uint64)]
        times = [np.ones(len(left), np.int64)]
        owner = [np.repeat(segment[plain], links[plain])]
        for g in np.flatnonzero(links > LARGE).tolist():
            (x, nx), (y, ny) = (np.unique(ids[k][start[k][g] : start[k][g] + size[k][g]], return_counts=True) for k in range(2))
            pairs.append((x.astype(np.uint64)[:, None] << np.uint64(32) | y.astype(np.uint64)[None]).ravel())
            times.append((nx[:, None] * ny[None]).ravel())
            owner.append(np.full(len(pairs[-1]), segment[g]))
        by = np.concatenate(owner)
        order = np.argsort(by, kind="stable")
        return counts, told, np.bincount(by, minlength=len(spelt)), np.concatenate(pairs)[order], np.concatenate(times)[order]


def byte_level(tokenizer) -> list[bytes]:
    """Bytes of each token of a byte-level vocabulary: printable bytes stand for themselves, the others in order for
    code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
    return [bytes(of[c] for c in (tokenizer.id_to_token(k) or "") if c in of) for k in range(tokenizer.get_vocab_size())]


def piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


_codecs: dict[tuple[str, str], Codecs] = {}


def codecs(path_a: str, path_b: str) -> Codecs:
    """One for each pair of vocabularies and worker process."""
    if (path_a, path_b) not in _codecs:
        _codecs[path_a, path_b] = Codecs(path_a, path_b)
    return _codecs[path_a, path_b]


# bitmaps


def part_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs) >> np.uint64(32)).astype(np.int64) % PARTS


class Postings(NamedTuple):
    """Documents of some pairs, one pair behind the other, and how often each is linked there."""

    pairs: np.ndarray
    counts: np.ndarray
    docs: np.ndarray
    times: np.ndarray


def pack(p: Postings, size: int) -> tuple[bytes, ...]:
    """Bitmaps over `size` documents: rare pairs as lists of documents, others as bits; a plane for each bit of `times`."""
    dense = p.counts * 16 > size
    of = np.repeat(dense, p.counts)
    bits = np.zeros((int(dense.sum()), size), bool)
    bits[np.repeat(np.arange(len(bits)), p.counts[dense]), p.docs[of]] = True
    planes = [np.packbits((p.times >> k & 1).astype(bool)).tobytes() for k in range(int(p.times.max(initial=1)).bit_length())]
    packed = zstandard.ZstdCompressor(level=1).compress
    raw = p.pairs.tobytes(), np.where(dense, 0, p.counts).astype("<u4").tobytes(), p.docs[~of].astype("<u2").tobytes(), np.packbits(bits, axis=1).tobytes(), b"".join(planes)
    return tuple(map(packed, raw))


def unpack(row: tuple[bytes, ...], size: int) -> Postings:
    pairs, counts, lists, bits, planes = map(zstandard.ZstdDecompressor().decompress, row)
    n = np.frombuffer(counts, "<u4").astype(np.int64)
    dense = n == 0
    maps = np.frombuffer(bits, np.uint8).reshape(int(dense.sum()), -(-size // 8))
    n[dense] = np.bitwise_count(maps).sum(1, dtype=np.int64)
    of = np.repeat(dense, n)
    docs = np.empty(len(of), np.int64)
    docs[~of] = np.frombuffer(lists, "<u2")
    docs[of] = np.nonzero(np.unpackbits(maps, axis=1))[1]
    width = -(-len(of) // 8)
    times = sum(np.unpackbits(np.frombuffer(planes[at : at + width], np.uint8), count=len(of)).astype(np.int64) << k for k, at in enumerate(range(0, len(planes), width)))
    return Postings(np.frombuffer(pairs, np.uint64), n, docs, times)


def _encode(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and for each chunk and part of the pairs a row with its postings."""
    chunk = (TaskContext.get().partitionId() << 33) - 1
    both = codecs(path_a, path_b)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at, texts in slices(batch.column(1), SLICE):
            chunk += 1
            spaced = [b" " + t if t else b"" for t in texts]
            start, end, owner, value = segments_of(spaced)
            _, first, place = np.unique(value, return_index=True, return_inverse=True)
            data = b"".join(spaced)
            at_cut = both.places([data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)])
            numbers = both.cuts.counts[at_cut]
            sums = np.zeros((len(texts), 5), np.int64)
            for k in range(5):
                sums[:, k] = np.bincount(owner, numbers[place, k], minlength=len(texts)).astype(np.int64)
            good = (sums[:, 0] == 0) & (np.fromiter(map(len, texts), np.int64, len(texts)) > 0)
            sums[~good] = 0
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
            told, places = [both.cuts.told[k] for k in at_cut.tolist()], place.tolist()
            shas = [
                hashlib.sha256(b";".join([told[x] for x in places[a:b]])).hexdigest() if ok else ""
                for a, b, ok in zip(bounds[:-1], bounds[1:], good.tolist(), strict=True)
            ]
            blank = (None,) * 7
            yield _batch(CHUNKS, [(chunk, k, ids[at + k], *row[1:], sha, *blank) for k, (row, sha) in enumerate(zip(sums.tolist(), shas, strict=True))])
            yield _batch(CHUNKS, [(chunk, *[None] * 7, *row) for row in _postings(both.cuts.linked(at_cut), place, owner, good)])


def _postings(linked: tuple[np.ndarray, ...], place: np.ndarray, owner: np.ndarray, good: np.ndarray) -> Iterator[tuple]:
    """(part, size, pairs, counts, lists, bits, planes) for the parts of the pairs that occur. `linked` has the pairs of
    the distinct segments, `place` which of these each segment is."""
    size = len(good)
    kept = good[owner]
    seen, often = np.unique(place[kept] * size + owner[kept], return_counts=True)
    if not len(seen):
        return
    segment, doc = np.divmod(seen, size)
    lengths, flat, times = linked
    offsets = np.cumsum(lengths) - lengths
    names, number = np.unique(flat, return_inverse=True)
    order = np.argsort(part_of(names), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    n = lengths[segment]
    at = ranges(offsets[segment], n)
    key = rank[number[at]] * size + np.repeat(doc, n)
    by = np.argsort(key, kind="stable")
    key, times = key[by], (times[at] * np.repeat(often, n))[by]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    times = np.add.reduceat(times, head)
    pair, doc = np.divmod(key[head], size)
    parts = part_of(names[order])
    cuts_ = np.searchsorted(pair, np.searchsorted(parts, np.arange(PARTS + 1)))
    for part, a, b in zip(range(PARTS), cuts_[:-1].tolist(), cuts_[1:].tolist(), strict=True):
        if a < b:
            some, counts = np.unique(pair[a:b], return_counts=True)
            yield part, size, *pack(Postings(names[order][some], counts, doc[a:b], times[a:b]), size)


# counts


def _grouped_sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.zeros(0, np.int64)
    return key[order][head], *(np.add.reduceat(v[order], head) if len(head) else v for v in values)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and links of each pair in the chunks of a task."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def told() -> pa.RecordBatch:
        pairs, docs, links = _grouped_sums(*(np.concatenate([h[k] for h in held]) for k in range(3)))
        columns = [pa.array(part_of(pairs).astype(np.int32)), pa.array(pairs.view(np.int64)), pa.array(docs), pa.array(links)]
        return pa.RecordBatch.from_arrays(columns, ["part", "pair", "docs", "links"])

    for batch in batches:
        for documents, *row in zip(batch.column(0).to_pylist(), *(texts_of(batch.column(k)) for k in range(1, 6)), strict=True):
            p = unpack(tuple(row), documents)
            first = np.concatenate([[0], np.cumsum(p.counts)[:-1]])
            held.append((p.pairs, p.counts, np.add.reduceat(p.times, first)))
            size += len(p.pairs)
            if size > PAIRS_HELD:
                held = [_grouped_sums(*(np.concatenate([h[k] for h in held]) for k in range(3)))]
                size = len(held[0][0])
                if size > PAIRS_HELD // 2:
                    yield told()
                    held, size = [], 0
    if held:
        yield told()


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document. Rows come by part and share; in each the counts of the pairs stand before the postings."""
    group = None
    held: list[tuple[np.ndarray, ...]] = []
    known: tuple[np.ndarray, ...] = ()
    for batch in batches:
        columns = [batch.column(k) for k in range(6)]
        part, share, tag = (columns[k].to_numpy() for k in range(3))
        step = np.flatnonzero((np.diff(part) != 0) | (np.diff(share) != 0) | (np.diff(tag) != 0)) + 1
        for a, b in zip([0, *step.tolist()], [*step.tolist(), len(part)], strict=True):
            if a == b:
                continue
            if group != (part[a], share[a]):
                group, held, known = (part[a], share[a]), [], ()
            if not tag[a]:
                held.append(tuple(columns[k].slice(a, b - a).to_numpy(zero_copy_only=False) for k in (3, 4, 5)))
                continue
            if not known:
                pair, docs, best = (np.concatenate([h[k] for h in held]) for k in range(3))
                order = np.argsort(pair.view(np.uint64))
                known, held = (pair.view(np.uint64)[order], docs[order], best[order].astype(np.int64)), []
            rows = []
            some = batch.slice(a, b - a)
            for chunk, size, *row in zip(some.column(6).to_pylist(), some.column(7).to_pylist(), *(texts_of(some.column(k)) for k in range(8, 13)), strict=True):
                p = unpack(tuple(row), size)
                at = np.searchsorted(known[0], p.pairs)
                total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
                np.add.at(total, p.docs, np.repeat(known[1][at], p.counts) * p.times)
                np.add.at(best, p.docs, np.repeat(known[2][at], p.counts) * p.times)
                there = np.flatnonzero(total)
                rows.append((chunk, there.astype("<u2").tobytes(), total[there].tobytes(), best[there].tobytes()))
            yield _batch(SUMS, rows)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each document over all parts; rows come by chunk."""
    chunk = None
    held: list[tuple[np.ndarray, ...]] = []

    def told() -> pa.RecordBatch:
        local, counts, best = _grouped_sums(*(np.concatenate([h[k] for h in held]) for k in range(3)))
        columns = [pa.array(np.full(len(local), chunk, np.int64)), pa.array(local.astype(np.int32)), pa.array(best), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "local", "n_best", "count_sum"])

    for batch in batches:
        for of, local, counts, best in zip(batch.column(0).to_pylist(), *(texts_of(batch.column(k)) for k in range(1, 4)), strict=True):
            if of != chunk and held:
                yield told()
                held = []
            chunk = of
            held.append((np.frombuffer(local, "<u2"), np.frombuffer(counts, np.int64), np.frombuffer(best, np.int64)))
    if held:
        yield told()


def _chunks(documents: DataFrame, path_a: str, path_b: str, doc_id: str, text: str) -> DataFrame:
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    return written(source.mapInArrow(lambda b: _encode(b, path_a, path_b), CHUNKS), "chunks")


def _pair_counts(chunks: DataFrame) -> DataFrame:
    bundles = chunks.filter("part IS NOT NULL").select("size", "pairs", "counts", "lists", "bits", "planes")
    partial = bundles.mapInArrow(_count, COUNTS)
    return partial.groupBy("part", "pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def pair_counts(documents: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per pair of ids that are linked anywhere: a, b, docs (documents that hold it), links."""
    pairs = _pair_counts(_chunks(documents, path_a, path_b, doc_id, text))
    return pairs.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b"), "docs", "links")


def align(documents: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `path_a` is a byte-level vocabulary, `path_b` a piece model that adds a space in front; both paths are the same on
    every machine. A text that is null, empty or not spelt by the tokens of both has no tokens: zeros, and '' for the
    checksum. Rows are documents, so repeated rows count each in the document counts. A null id stays null; other columns
    are left out, also those named like an output; an empty table gives no rows.
    """
    size = documents.agg(F.sum(F.octet_length(quoted(text).cast("string")).cast("long"))).first()[0] or 0
    shares = max(1, -(-size // BYTES_PER_TASK))
    chunks = _chunks(documents, path_a, path_b, doc_id, text)
    pairs = written(_pair_counts(chunks), "pairs")
    # Of the ids of one vocabulary there are some ten thousands, so the maxima are few rows.
    highest = pairs.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("docs").alias("most"))
    ranked = pairs.withColumn("a", F.shiftright("pair", 32)).join(highest, "a").select("part", "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    counted = ranked.select(
        "part", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("tag"), "pair", F.col("docs").alias("n"), "best"
    )
    columns = ["chunk", "size", "pairs", "counts", "lists", "bits", "planes"]
    share = F.pmod(F.xxhash64("chunk"), F.lit(shares)).cast("int")
    postings = chunks.filter("part IS NOT NULL").select("part", share.alias("share"), F.lit(1).alias("tag"), *columns)
    both = counted.unionByName(postings, allowMissingColumns=True)
    dealt = both.repartition(PARTS * shares, "part", "share").sortWithinPartitions("part", "share", "tag")
    sums = dealt.mapInArrow(_scored, SUMS)
    scores = sums.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed, SCORES)
    rows = chunks.filter("local IS NOT NULL").select("chunk", "local", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    none = F.lit(0).cast("long")
    return rows.join(scores, ["chunk", "local"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"
    )
