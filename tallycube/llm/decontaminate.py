"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is a run of `WINDOW` consecutive words of an item. As a set it consists of its shingles of three words. All of
them must occur in a document that holds the window, so one of them, the rarest in the corpus, is a sufficient prefix.
Documents are joined on those prefix shingles only; positions bound where the window can lie, and its words are compared
there one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tallycube.llm.common import bit_filter, fresh, passes, quoted, shielded, slices, tidy, written
from tallycube.llm.shingles import LETTERS, Words

WINDOW = 10
SHINGLE = 3
FILTER_BITS = 22  # bits of the hash that address the filter of shingles: 512 kB, whatever the size of the benchmark
COUNTED = 200_000  # distinct shingles a task counts before it passes its counts on

WINDOWS = "item_id string, window long, words array<string>, shingles array<long>"
COUNTS = "shingle long, times long"
CANDIDATE = "struct<shingle:long,at:int,before:int,context:array<string>>"
PROBED = f"row long, doc_id long, text_hash long, n_words long, candidates array<{CANDIDATE}>"
ARROW_CANDIDATES = pa.list_(
    pa.struct([("shingle", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("context", pa.list_(pa.string()))])
)


@tidy
def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in fresh(batches):
        ids = batch.column(0).to_pylist()
        for at, texts in slices(batch.column(1)):
            w = Words(texts, LETTERS)
            of_size = {n: dict(zip((p := w.runs(n))[1].tolist(), p[0].view(np.int64).tolist(), strict=True)) for n in range(1, SHINGLE + 1)}
            rows = []
            for k in range(len(texts)):
                a, b = int(w.first[k]), int(w.first[k + 1])
                size = min(WINDOW, b - a)
                words = [w.word(i) for i in range(a, b)]
                shingle = min(SHINGLE, size)
                for i in range(a, b - size + 1) if size else ():
                    hashes = [of_size[shingle][j] for j in range(i, i + size - shingle + 1)]
                    rows.append((ids[at + k], i - a, words[i - a : i - a + size], hashes))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item_id", "window", "words", "shingles"])


@tidy
def _count(batches: Iterator[pa.RecordBatch], shared, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, int] = {}

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["shingle", "times"])

    for batch in fresh(batches):
        for _, texts in slices(batch.column(0)):
            w = Words(texts, LETTERS)
            for n in sizes:
                hashes, _ = w.runs(n)
                found, times = np.unique(hashes[passes(shared.value, hashes)], return_counts=True)
                for h, t in zip(found.view(np.int64).tolist(), times.tolist(), strict=True):
                    counts[h] = counts.get(h, 0) + t
            if len(counts) > COUNTED:
                yield told()
                counts.clear()
    yield told()


@tidy
def _probe(batches: Iterator[pa.RecordBatch], shared, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    reach = WINDOW - 1
    for batch in fresh(batches):
        ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for at, texts in slices(batch.column(1)):
            w = Words(texts, LETTERS)
            found: list[list] = [[] for _ in texts]
            for n in sizes:
                hashes, places = w.runs(n)
                hit = passes(shared.value, hashes)
                for h, k in zip(hashes[hit].view(np.int64).tolist(), places[hit].tolist(), strict=True):
                    owner = int(w.owner[k])
                    low, high = max(int(w.first[owner]), k - reach), min(int(w.first[owner + 1]), k + WINDOW)
                    found[owner].append({"shingle": h, "at": k - int(w.first[owner]), "before": k - low, "context": [w.word(i) for i in range(low, high)]})
            n_words = np.diff(w.first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + len(texts)), pa.int64()),
                    pa.array(ids[at : at + len(texts)], pa.int64()),
                    pa.array(keys[at : at + len(texts)], pa.int64()),
                    pa.array(n_words, pa.int64()),
                    pa.array(found, ARROW_CANDIDATES),
                ],
                ["row", "doc_id", "text_hash", "n_words", "candidates"],
            )
            row += len(texts)


def contamination(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, text_hash (of the text), n_words, n_hit, items (ids as sorted text), contaminated.

    A null text has no words and is never contaminated; an item without words has no window. A null item id counts as
    the text "null". Repeated rows are judged each; rows of one id with different texts keep apart by `text_hash`.
    With an empty benchmark no document is contaminated; an empty table gives no rows. Other columns are left out.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.coalesce(quoted(item_id).cast("string"), F.lit("null")).alias("item_id"), quoted(item_text).cast("string").alias("text"))
    windows = written(items.mapInArrow(_windows, WINDOWS), "windows")
    sizes = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect())
    shingles = windows.select(F.explode("shingles").alias("shingle")).distinct()
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    all_shingles = spark.sparkContext.broadcast(bit_filter(shingles, FILTER_BITS))
    counts = (
        source.select("text").mapInArrow(lambda b: _count(b, all_shingles, sizes), COUNTS).groupBy("shingle").agg(F.sum("times").alias("times"))
    )
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset"))
    prefix = written(
        windows.select("item_id", "window", "words", F.posexplode("shingles").alias("offset", "shingle"))
        .join(counts, "shingle", "left")
        .groupBy("item_id", "window", "words")
        .agg(rarest.alias("rarest"))
        .select("item_id", "words", F.size("words").alias("n"), "rarest.shingle", "rarest.offset"),
        "prefixes",
    )
    prefix_filter = spark.sparkContext.broadcast(bit_filter(prefix.select("shingle"), FILTER_BITS))
    keyed = source.withColumn("text_hash", F.xxhash64("text"))
    probed = written(keyed.mapInArrow(lambda b: _probe(b, prefix_filter, sizes), PROBED), "probed")
    # The window starts `offset` words before the shingle: that word must be in the context, as must the last one.
    hits = (
        probed.select("row", F.explode("candidates").alias("c"))
        .select("row", "c.*")
        .join(prefix, "shingle")
        .filter((F.col("before") >= F.col("offset")) & (F.size("context") >= F.col("before") - F.col("offset") + F.col("n")))
        .filter(F.slice("context", F.col("before") - F.col("offset") + 1, F.col("n")) == F.col("words"))
        .select("row", (F.col("at") - F.col("offset")).alias("start"), "n", "item_id")
    )
    # Length of the union of the hit ranges: walk them by start, and count what lies beyond the end so far.
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "n"))),
        none,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["start"] + x["n"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(s["end"], x["start"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    found = hits.groupBy("row").agg(union.alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    return (
        probed.drop("candidates")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def clean_documents(documents: DataFrame, verdicts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the contaminated ones."""
    bad = verdicts.filter("contaminated").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()

    def clean(plain: DataFrame, id_: str, text_: str) -> DataFrame:
        return plain.join(bad, F.col(id_).cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.col(text_).cast("string")) == F.col("hash")), "left_anti")

    return shielded(documents, [], [doc_id, text], clean)
