"""Ranked lexical search: the best documents of each query, exactly, in the manner of LEMP.

A document's score is the product of a query vector (weights of its terms) and an impact vector (saturated term counts).
Only terms of the queries matter, so a document is reduced to those once. Impact vectors are ordered by length and cut
into buckets of similar length. The longest ones are searched first and give each query a threshold: the score it has to
beat. Of the others, the Cauchy-Schwarz inequality rules out whole buckets for a query. Inside a bucket, the products over
a query's heaviest coordinates are formed, and the rest is bounded by the lengths of what is left of both vectors and by the
largest value of each coordinate; documents that may still beat the threshold are scored again in integers.

Both vectors are scaled by the square roots of the weights, which changes no product and makes the bounds tighter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tallycube.llm.common import quoted, slices, texts_of, written
from tallycube.llm.shingles import LETTERS, Words

BEST = 20
BLOCK_BYTES = 2_000_000  # of query texts, searched together; more queries are searched block by block
FIRST_DOCS = 2_000  # documents that give the first thresholds, at least, if there are as many
RATIO = 1.25  # of the lengths in a bucket
IN_BUCKET = 4_096  # documents compared at once
PER_TASK = 20_000  # documents dealt to a task, about
FOCUS = 0.2  # heaviest coordinates are those without which less than this share of the length is left
SLACK = 1e-9  # relative error allowed for in bounds
NO_ID = np.iinfo(np.int64).max  # ties: after all ids

VECTORS = "row long, doc_id long, n long, terms binary, times binary, seen binary"
COUNTS = "term int, df long"
PLACED = "bucket int, split int, norm double, doc_id long, n long, terms binary, times binary"
FOUND = "query int, doc_id long, score long"


@dataclass(frozen=True)
class Queries:
    """Distinct query texts of one block; `terms`, numbers of vocabulary words, with their repeats, of each."""

    texts: list[str]
    vocabulary: np.ndarray  # sorted hashes of the words
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def read_queries(texts: list[str]) -> Queries:
    w = Words([t.encode() for t in texts], LETTERS)
    vocabulary = np.unique(w.hash)
    at = np.searchsorted(vocabulary, w.hash)
    found = [np.unique(at[a:b], return_counts=True) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    return Queries(texts, vocabulary, [t for t, _ in found], [c for _, c in found])


def _vectors(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Each document's number of words and counts of query terms; at the end of a task, in how many of its documents
    each term occurs."""
    vocabulary = shared.value
    seen = np.zeros(len(vocabulary), np.int64)
    row = (TaskContext.get().partitionId() << 33) - 1
    kinds = [*[pa.int64()] * 3, *[pa.binary()] * 3]
    names = [f.split()[0] for f in VECTORS.split(", ")]
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at, texts in slices(batch.column(1), 2_000_000):
            w = Words(texts, LETTERS)
            place = np.minimum(np.searchsorted(vocabulary, w.hash), max(len(vocabulary) - 1, 0))
            known = np.flatnonzero(vocabulary[place] == w.hash) if len(vocabulary) else np.zeros(0, np.int64)
            both, times = np.unique(w.owner[known] * max(len(vocabulary), 1) + place[known], return_counts=True)
            owner, term = np.divmod(both, max(len(vocabulary), 1))
            seen += np.bincount(term, minlength=len(seen))[: len(seen)]
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
            term, times = term.astype("<u4"), times.astype("<u4")
            rows = [(term[a:b].tobytes(), times[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            numbers = list(range(row + 1, row + 1 + len(texts)))
            row += len(texts)
            columns = [numbers, ids[at : at + len(texts)], np.diff(w.first), [r[0] for r in rows], [r[1] for r in rows], [None] * len(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
    columns = [[None]] * 5 + [[seen.tobytes()]]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray | int = 0
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            total = total + np.frombuffer(raw, np.int64)
    if not isinstance(total, int):
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(total[term], pa.int64())], ["term", "df"])


@dataclass(frozen=True)
class Corpus:
    """What scores need of the whole corpus: documents and words in it, and the weight of each vocabulary term."""

    documents: int
    words: int
    weights: np.ndarray

    def impacts(self, n: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Integer impact of each term count in a document of n words."""
        m = 75 + (25 * n * self.documents) // max(self.words, 1)
        return (1_000_000_000 * times) // (1000 * times + 12 * m)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Rows:
    """Vectors of some documents, one behind the other; `start` has one more entry than documents."""

    doc: np.ndarray
    start: np.ndarray
    term: np.ndarray
    impact: np.ndarray
    scaled: np.ndarray
    norm: np.ndarray


def rows_of(doc: list, n: np.ndarray, terms: list[bytes], times: list[bytes], corpus: Corpus) -> Rows:
    lengths = np.fromiter((len(t) // 4 for t in terms), np.int64, len(terms))
    start = np.concatenate([[0], np.cumsum(lengths)])
    term = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
    count = np.frombuffer(b"".join(times), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(terms)), lengths)
    impact = corpus.impacts(n[owner], count)
    scaled = impact * np.sqrt(corpus.weights[term])
    norm = np.sqrt(np.bincount(owner, scaled * scaled, minlength=len(terms)))
    return Rows(np.array([NO_ID if d is None else d for d in doc], np.int64), start, term, impact, scaled, norm)


def _placed(batches: Iterator[pa.RecordBatch], shared, splits: int) -> Iterator[pa.RecordBatch]:
    """Documents with a query term, with their bucket. Buckets are numbered from short to long."""
    corpus = shared.value
    names = [f.split()[0] for f in PLACED.split(", ")]
    for batch in batches:
        n = batch.column(2).to_numpy()
        terms, times = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        norm = rows_of([0] * len(n), n, terms, times, corpus).norm
        bucket = np.floor(np.log(np.maximum(norm, 1.0)) / math.log(RATIO)).astype(np.int32)
        split = (batch.column(0).to_numpy() % splits).astype(np.int32)
        there = pa.array(np.flatnonzero(norm > 0))
        columns = [pa.array(bucket), pa.array(split), pa.array(norm), batch.column(1), batch.column(2), batch.column(3), batch.column(4)]
        yield pa.RecordBatch.from_arrays([c.take(there) for c in columns], names)


class Search:
    """The best documents of each query so far, by score, then by id."""

    def __init__(self, queries: Queries, corpus: Corpus, thresholds: np.ndarray, best: int):
        self.queries, self.corpus, self.best = queries, corpus, best
        self.threshold = thresholds.copy()
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.terms]
        self.plans = []
        for terms, repeats in zip(queries.terms, queries.repeats, strict=True):
            scaled = repeats * np.sqrt(corpus.weights[terms])
            order = np.argsort(-scaled, kind="stable")
            left = np.sqrt(np.maximum(np.append(np.cumsum((scaled[order] ** 2)[::-1])[::-1], 0), 0))
            focus = int(np.argmax(left <= FOCUS * left[0]))
            self.plans.append((terms[order], scaled[order], focus, left[0], left[focus]))
        self.whole = np.zeros(len(queries.vocabulary), np.int64)

    def add(self, rows: Rows) -> None:
        """Compare all queries with documents of about the same length."""
        size = len(rows.doc)
        owner = np.repeat(np.arange(size), np.diff(rows.start))
        order = np.argsort(rows.term, kind="stable")
        begin = np.searchsorted(rows.term[order], np.arange(len(self.queries.vocabulary) + 1))
        by_term, scaled = owner[order], rows.scaled[order]
        longest = rows.norm.max(initial=0.0)
        largest = np.zeros(len(begin))
        there = np.flatnonzero(np.diff(begin))
        largest[there] = np.maximum.reduceat(scaled, begin[there]) if len(there) else 0
        for q, (terms, weights, focus, length, rest) in enumerate(self.plans):
            least = self.threshold[q]
            if not length or length * longest * (1 + SLACK) < least:
                continue  # the whole bucket
            product, taken = np.zeros(size), np.zeros(size)
            for t, weight in zip(terms[:focus].tolist(), weights[:focus].tolist(), strict=True):
                docs, x = by_term[begin[t] : begin[t + 1]], scaled[begin[t] : begin[t + 1]]
                product[docs] += weight * x
                taken[docs] += x * x
            # What is left of a document is known up to the rounding of its length.
            most = float(weights[focus:] @ largest[terms[focus:]])
            bound = product + np.minimum(rest * np.sqrt(np.maximum(rows.norm**2 * (1 + SLACK) - taken, 0)), most)
            some = np.flatnonzero(bound * (1 + SLACK) >= least)
            if len(some):
                self._keep(q, rows.doc[some], self._scores(q, rows, some))

    def _scores(self, q: int, rows: Rows, some: np.ndarray) -> np.ndarray:
        terms = self.queries.terms[q]
        self.whole[terms] = self.corpus.weights[terms] * self.queries.repeats[q]
        lengths = np.diff(rows.start)[some]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) - np.repeat(ends - lengths - rows.start[some], lengths)
        parts = np.concatenate([[0], np.cumsum(self.whole[rows.term[at]] * rows.impact[at])])
        self.whole[terms] = 0
        return parts[ends] - parts[ends - lengths]

    def _keep(self, q: int, docs: np.ndarray, scores: np.ndarray) -> None:
        good = (scores > 0) & (scores >= self.threshold[q])
        docs, scores = np.concatenate([self.kept[q][0], docs[good]]), np.concatenate([self.kept[q][1], scores[good]])
        order = np.lexsort((docs, -scores))[: self.best]
        self.kept[q] = docs[order], scores[order]
        if len(order) == self.best:
            self.threshold[q] = max(self.threshold[q], int(scores[order[-1]]))


def _search(batches: Iterator[pa.RecordBatch], shared, thresholds, best: int) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, the longest first; a part of a bucket is compared at once."""
    queries, corpus = shared.value
    search = Search(queries, corpus, thresholds.value, best)
    held: list[pa.RecordBatch] = []

    def compared() -> None:
        table = pa.Table.from_batches(held)
        held.clear()
        columns = [table.column(k) for k in range(3, 7)]
        doc, terms, times = columns[0].to_pylist(), columns[2].to_pylist(), columns[3].to_pylist()
        search.add(rows_of(doc, columns[1].to_numpy(), terms, times, corpus))

    for batch in batches:
        buckets = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and (held[0].column(0)[0].as_py() != buckets[a] or sum(len(h) for h in held) >= IN_BUCKET):
                compared()
            held.append(batch.slice(a, b - a))
    if held:
        compared()
    for q, (docs, scores) in enumerate(search.kept):
        if len(docs):
            ids = pa.array([None if d == NO_ID else d for d in docs.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), q, np.int32)), ids, pa.array(scores)], ["query", "doc_id", "score"])


def _best(found: DataFrame, best: int) -> DataFrame:
    """Each query's best documents with their rank; a task has found `best` of them at most."""
    from pyspark.sql import Window

    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= best)


def _block(spark: SparkSession, source: DataFrame, queries: Queries, best: int) -> DataFrame:
    """(query, rank, doc_id, score) of one block of queries."""
    context = spark.sparkContext
    words = context.broadcast(queries.vocabulary)
    vectors = written(source.mapInArrow(lambda b: _vectors(b, words), VECTORS), "vectors")
    documents, total = vectors.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    counts = vectors.filter("seen IS NOT NULL").select("seen").mapInArrow(_document_counts, COUNTS)
    df = np.zeros(len(queries.vocabulary), np.int64)
    told = counts.groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # a row for each word of the block
    df[told.column(0).to_numpy()] = told.column(1).to_numpy()
    weights = np.array([term_weight(documents, int(x)) for x in df], np.int64)
    corpus = Corpus(documents, total or 0, weights)
    shared, known = context.broadcast((queries, corpus)), context.broadcast(corpus)
    splits = max(1, -(-documents // PER_TASK))
    there = vectors.filter("n > 0").select("row", "doc_id", "n", "terms", "times")
    placed = there.mapInArrow(lambda b: _placed(b, known, splits), PLACED)
    # One row for each bucket; a length of 1.25^200 is beyond any vector.
    sizes = {r["bucket"]: r["count"] for r in placed.groupBy("bucket").count().collect()}
    border, first = 0, 0
    for bucket in sorted(sizes, reverse=True):
        border, first = bucket, first + sizes[bucket]
        if first >= FIRST_DOCS:
            break

    def searched(rows: DataFrame, tasks: int, thresholds: np.ndarray) -> DataFrame:
        at = context.broadcast(thresholds)
        dealt = rows.repartition(tasks, "bucket", "split").sortWithinPartitions(F.desc("bucket"), F.desc("norm"))
        return written(dealt.mapInArrow(lambda b: _search(b, shared, at, best), FOUND), "found")

    none = np.zeros(len(queries.texts), np.int64)
    longest = searched(placed.filter(F.col("bucket") >= border), max(2, -(-first // PER_TASK)), none)
    least = none.copy()
    for r in _best(longest, best).filter(F.col("rank") == best).select("query", "score").collect():  # a row for each query
        least[r["query"]] = r["score"]
    # A document shorter than this cannot come up to the threshold of any query.
    lengths = np.array([plan[3] for plan in Search(queries, corpus, none, best).plans])
    some = lengths > 0
    shortest = float((least[some] / lengths[some]).min()) * (1 - SLACK) if some.any() else 0.0
    rest = placed.filter((F.col("bucket") < border) & (F.col("norm") >= shortest))
    others = searched(rest, max(2, splits), least)
    return _best(longest.unionByName(others), best)


def search(
    documents: DataFrame, items: DataFrame, best: int = BEST, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each item and document found: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased; they are compared by
    64-bit hashes. Of equal scores the smaller doc_id ranks first, and a null id last; a repeated row is ranked as often
    as it occurs. A document without a term takes no part. A repeated item is answered each time; an item without a term,
    or whose terms occur nowhere, has no rows. Other columns are left out. Empty tables give no rows.

    Items of equal text are one query. Queries are searched in blocks of about BLOCK_BYTES of text, so that what is
    broadcast and what comes to the driver is bounded by that; each block reads the documents once.
    """
    spark = documents.sparkSession
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    asked = items.select(quoted(item_id).alias("item_id"), F.coalesce(quoted(item_text).cast("string"), F.lit("")).alias("query_text"))
    distinct = written(asked.select("query_text").distinct().withColumn("h", F.xxhash64("query_text")), "queries")
    size = distinct.agg(F.sum(F.octet_length("query_text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = []
    for k in range(blocks):
        texts = [r[0] for r in distinct.filter(F.pmod("h", F.lit(blocks)) == k).select("query_text").orderBy("query_text").collect()]
        if texts:
            named = spark.createDataFrame(pa.table({"query": pa.array(range(len(texts)), pa.int32()), "query_text": pa.array(texts, pa.string())}))
            out.append(_block(spark, source, read_queries(texts), best).join(F.broadcast(named), "query").drop("query"))
    kind = items.schema[item_id].dataType
    if not out:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind)]).add("rank", "integer").add("doc_id", "long").add("score", "long"))
    answers = out[0]
    for more in out[1:]:
        answers = answers.unionByName(more)
    return asked.join(answers, "query_text").select("item_id", "rank", "doc_id", "score")
