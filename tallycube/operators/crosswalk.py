"""Two code lists set against each other: compliance and its exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.operators.joins import drop_listed, full_join, full_join_unique, keep_listed


def crosswalk(source: DataFrame, target: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """Full match of a source list (code, source_description) with a target list (code, target_description).

    A row is compliant when both descriptions agree or its code was approved by hand (column code).
    `source_code` is null where the source lacks the code, `code` where the target does; a code without a description is
    there all the same.
    """
    matched = full_join(source.withColumn("_source", F.lit(True)), target.withColumn("_target", F.lit(True)), ["code"])
    if approved is None:
        ok = F.lit(False)
    else:
        marks = approved.select("code").distinct().withColumn("_ok", F.lit(True))
        matched = matched.join(marks, "code", "left")
        # Only a code the target knows can be approved.
        ok = F.coalesce("_ok", F.lit(False)) & F.col("_target").isNotNull()
    same = F.coalesce(F.col("source_description") == F.col("target_description"), F.lit(False))
    return matched.select(
        F.when(F.col("_target"), F.col("code")).alias("code"),
        "source_description",
        "target_description",
        F.when(F.col("_source"), F.col("code")).alias("source_code"),
        (same | ok).alias("compliant"),
    )


def exceptions(table: DataFrame) -> DataFrame:
    """Rows of a crosswalk that need a look, with the reason in `exception`."""
    left, right = F.col("source_description"), F.col("target_description")
    return table.withColumn(
        "exception",
        F.when(F.col("source_code").isNull(), "target_only").when(F.col("code").isNull(), "source_only").when(~left.eqNullSafe(right), "differs"),
    ).filter("exception is not null")


def matched_elsewhere(table: DataFrame) -> DataFrame:
    """Non-compliant codes whose target description occurs as source description of another such row."""
    open_rows = table.filter(~F.col("compliant"))
    names = open_rows.select("source_description").dropna().distinct()
    return keep_listed(open_rows, names, "target_description", "source_description")


def compare_memberships(left: DataFrame, right: DataFrame) -> DataFrame:
    """Membership pairs (group_code, member_code) of two lists, with the side(s) they occur on."""
    by = ["group_code", "member_code"]
    pairs = full_join_unique(
        left.select(*by).distinct().withColumn("_l", F.lit(True)),
        right.select(*by).distinct().withColumn("_r", F.lit(True)),
        by,
    )
    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("both")
    return pairs.select(*by, side.alias("side"))


def new_codes(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    return drop_listed(df.select(column).distinct(), known, column)
