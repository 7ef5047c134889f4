"""A corpus from documents to packed sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallycube.llm import decontaminate, near, packing, pii, quality
from tallycube.llm.common import quoted, read_table, written
from tallycube.llm.queries import PSEUDONYM_KEY, word_vocabulary


def _with_own_columns(docs: DataFrame, outputs: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the operator gives, with the columns of `docs` only. Those named like an output have another name meanwhile."""
    taken = {n.lower() for n in outputs}
    names = [f"_own_{k}" if c.lower() in taken else c for k, c in enumerate(docs.columns)]
    out = operator(docs.select(*[quoted(c).alias(n) for c, n in zip(docs.columns, names, strict=True)]))
    return out.select(*[quoted(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _with_own_columns(docs, quality.OUTPUT, lambda d: quality.judge(d).filter("kept"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, a similarity of 0.8 or more."""
    return near.keep_one(docs, near.join_similar(docs, size=5, percent=80))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return decontaminate.clean_documents(docs, found)


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with validated numbers, dates and addresses under pseudonyms."""
    return _with_own_columns(docs, pii.OUTPUT, lambda d: pii.pseudonymise(d, PSEUDONYM_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, word_vocabulary(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii_pseudonyms),
    ("packing", pack),
]

# Packing depends on how rows meet in partitions, and the token ids need the vocabulary: neither can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
