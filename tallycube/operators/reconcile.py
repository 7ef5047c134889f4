"""Two publications of the same figures set against each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.functions import percent_change, relative_change
from tallycube.operators.joins import full_join_unique
from tallycube.schema import FEMALE, MALE, POPULATION, TOTAL, VALUE_TYPE, Dims

# Status codes of the reconciliation.
STATUS_EQUAL = "ok"
STATUS_DIFFERENT = "no"
STATUS_FIRST_ONLY = "first_only"
STATUS_SECOND_ONLY = "second_only"
STATUS_UNKNOWN = "?"


def reconcile(first: DataFrame, second: DataFrame, on: Sequence[str], value: str = "Value") -> DataFrame:
    """Status per key of two publications and, where they differ, the rounded difference.

    Each has one row per key, as a cube does; a key that occurs twice is an error.
    """
    a, b = F.col("value_first"), F.col("value_second")
    status = (
        F.when(a == b, STATUS_EQUAL)
        .when(a != b, STATUS_DIFFERENT)
        .when(a.isNull() & b.isNotNull(), STATUS_SECOND_ONLY)
        .when(a.isNotNull() & b.isNull(), STATUS_FIRST_ONLY)
        .otherwise(STATUS_UNKNOWN)
    )
    return (
        full_join_unique(
            first.select(*on, F.col(value).alias("value_first")),
            second.select(*on, F.col(value).alias("value_second")),
            on,
        )
        .withColumn("check", status)
        .withColumn("diff", F.when(F.col("check") == STATUS_DIFFERENT, F.round(b - a, 6)))
    )


def match_rate(reconciled: DataFrame) -> DataFrame:
    """Counts per status over the whole comparison, and the share of equal rows."""
    checks = (STATUS_EQUAL, STATUS_DIFFERENT, STATUS_FIRST_ONLY, STATUS_SECOND_ONLY, STATUS_UNKNOWN)
    names = ("n_equal", "n_different", "n_first_only", "n_second_only", "n_unknown")
    counts = [F.count(F.when(F.col("check") == c, 1)).alias(n) for c, n in zip(checks, names)]
    return reconciled.agg(F.count(F.lit(1)).alias("n"), *counts).withColumn(
        "match_rate", F.try_divide(F.col("n_equal").cast("double"), F.col("n").cast("double"))
    )


def compare(first: DataFrame, second: DataFrame, on: Sequence[str], value: str = "Value") -> DataFrame:
    """Rows present in both publications, with absolute, relative and percent change of the first."""
    both = first.select(*on, F.col(value).alias("value_first")).join(
        second.select(*on, F.col(value).alias("value_second")), list(on)
    )
    return both.withColumns(
        {
            "difference": F.col("value_first") - F.col("value_second"),
            "change": relative_change("value_first", "value_second"),
            "percent": percent_change("value_first", "value_second"),
        }
    )


def large_changes(compared: DataFrame, threshold: float = 0.20) -> DataFrame:
    return compared.filter(F.abs("change") > threshold)


def area_totals(
    published: DataFrame, computed: DataFrame, on: Sequence[str], tolerance: str = "0.1", value: str = "Value"
) -> DataFrame:
    """Published against computed totals by label and year, in a band: above, below or within."""
    bound = F.lit(tolerance).cast(VALUE_TYPE)
    compared = compare(
        published.withColumn(value, F.round(value, 3)), computed, on, value
    ).select(*on, "value_first", "value_second", "difference")
    band = F.when(F.col("difference") > bound, "above").when(F.col("difference") < -bound, "below").otherwise("within")
    return compared.withColumn("band", band)


def original_check(
    stored: DataFrame, original: DataFrame, on: Sequence[str], value: str = "Value"
) -> DataFrame:
    """Stored values against the rounded original; null where a side is missing."""
    rows = full_join_unique(
        stored.select(*on, F.col(value).alias("value_stored")),
        original.select(*on, F.round(value, 3).alias("value_original")),
        on,
    )
    return rows.withColumn("equal", F.col("value_stored") == F.col("value_original"))


def identity_check(
    cube: DataFrame, members: DataFrame, residuals: DataFrame, dims: Dims = POPULATION
) -> DataFrame:
    """Per parent and year: sexes of the members plus the residual, next to the members' total.

    `members` is (parent, member), and the area of a residual is `parent.01`.
    """
    sexes = F.col(dims.element).isin(MALE, FEMALE)
    rows = (
        cube.filter(sexes | (F.col(dims.element) == TOTAL))
        .join(members.withColumnRenamed("member", dims.area), dims.area)
        .select("parent", dims.year, dims.element, dims.value)
    )
    extra = residuals.filter(sexes).select(
        F.regexp_replace(dims.area, r"\.01$", "").alias("parent"), dims.year, dims.element, dims.value
    )
    # The residual joins the sum as further rows, so one aggregation gives both sides.
    out = (
        rows.unionByName(extra)
        .groupBy("parent", dims.year)
        .agg(
            F.sum(F.when(sexes, F.col(dims.value))).alias("parts"),
            F.sum(F.when(~sexes, F.col(dims.value))).alias("total"),
        )
    )
    return out.withColumn("holds", F.col("parts") == F.col("total"))


def cube_difference(first: DataFrame, second: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, over all years and columns, that only one of two cubes has, each once with that side (`first`, `second`).

    One aggregation finds both directions, and treats nulls as equal like a set difference does.
    """
    columns = list(columns or first.columns)
    both = first.select(*columns, F.lit(True).alias("_first")).unionByName(second.select(*columns, F.lit(False).alias("_first")))
    sides = both.groupBy(*columns).agg(F.max("_first").alias("_any"), F.min("_first").alias("_all"))
    return sides.filter(F.col("_any") == F.col("_all")).select(*columns, F.when(F.col("_any"), "first").otherwise("second").alias("side"))


def totals_by_validity(df: DataFrame, validity: DataFrame, aliases: Sequence[str] = (), dims: Dims = POPULATION) -> DataFrame:
    """Control totals (areas, n, total) of areas whose validity has no end (`open`), of the others (`ended`), and of `all`
    without the aliases, which would count twice.

    `validity` is (m49, start_year, end_year); an area with several intervals is open if one of them is. Areas without an
    interval count as open.
    """
    ended = validity.groupBy(F.col("m49").alias(dims.area)).agg(F.min(F.col("end_year").isNotNull()).alias("_ended"))
    rows = df.filter(~F.col(dims.area).isin(list(aliases))) if aliases else df
    kind = F.when(F.col("_ended"), "ended").otherwise("open")
    counted = rows.join(ended, dims.area, "left").groupBy(kind.alias("areas")).agg(F.count(F.lit(1)).alias("n"), F.sum(dims.value).alias("total"))
    return counted.unionByName(counted.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).withColumn("areas", F.lit("all")))


def control_total(df: DataFrame, value: str = "Value") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def paired_differences(compared: DataFrame, pairs: DataFrame, on: str, year: str = POPULATION.year, value: str = "difference") -> DataFrame:
    """Differences of two areas next to each other, by year.

    `compared` has one row per area (column `on`) and year; `pairs` has left, right, and optionally from_year and to_year,
    null for no bound. A year is told if both areas have a row in it. Each pair is one group of rows: its two areas are
    looked up at once and the values picked by side, so `compared` is read once.
    """
    bounds = [F.col(c) if c in pairs.columns else F.lit(None).cast("int") for c in ("from_year", "to_year")]
    sides = pairs.select("left", "right", bounds[0].alias("_from"), bounds[1].alias("_to")).distinct()
    wanted = sides.select("*", F.explode(F.array_distinct(F.array("left", "right"))).alias(on))
    inside = (F.col("_from").isNull() | (F.col(year) >= F.col("_from"))) & (F.col("_to").isNull() | (F.col(year) <= F.col("_to")))
    rows = compared.select(on, year, value).join(wanted, on).filter(inside)
    picked = rows.groupBy("left", "right", "_from", "_to", year).agg(
        *[F.max(F.when(F.col(on) == F.col(s), F.col(value))).alias(f"{value}_{s}") for s in ("left", "right")],
        *[F.max(F.col(on) == F.col(s)).alias(f"_{s}") for s in ("left", "right")],
    )
    return picked.filter("_left and _right").select("left", "right", year, f"{value}_left", f"{value}_right").distinct()
