"""One query per operator, over whole tables with production parameters, and SQL where it can be said in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tallycube.llm import alignment, decontaminate, licences, near, packing, pii, quality, quotes, ranked, secrets, sharding, suffixes, toxicity
from tallycube.llm.common import read_table
from tallycube.llm.sql import SQL

__all__ = ["QUERIES", "SQL", "PSEUDONYM_KEY", "word_vocabulary"]

Query = Callable[[SparkSession, str], DataFrame]


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), word_vocabulary(), with_ids=False)


def op2_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link(read_table(spark, folder, "conversations"))


# A key for these queries; in use it comes from the caller's secret store.
PSEUDONYM_KEY = "demonstration key"


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    done = pii.pseudonymise(read_table(spark, folder, "documents"), PSEUDONYM_KEY)
    return done.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_replaced"), F.array_join("pii_kinds", ",").alias("kinds"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    net = secrets.fit(secrets.labelled_findings(documents))
    found = secrets.scan(documents, net)
    base = F.filter("secrets", lambda s: s["kind"] != "learned")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(documents, labels.filter(~held_out))
    return model.score(documents).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.size("licences").cast("long").alias("n_licences"), F.array_join("licences", ",").alias("licences"), "best_licence", "best_dice")


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near.join_similar(read_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(read_table(spark, folder, "documents"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.remove_repeats(read_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(read_table(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(read_table(spark, folder, "documents"), *paths)


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_quotation_linking": op2_quotation_linking,
    "op3_pii": op3_pii,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_licences": op7_licences,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_sharding": op11_sharding,
    "op12_ranked_search": op12_ranked_search,
    "op13_alignment": op13_alignment,
}
