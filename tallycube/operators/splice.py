"""Estimates and projections of one series, which overlap in a common year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.schema import POPULATION, Dims


def splice(estimates: DataFrame, projections: DataFrame, common_year: int, dims: Dims = POPULATION) -> DataFrame:
    """Estimates for all their years, projections for all years but the common one."""
    later = projections.filter(F.col(dims.year) != common_year)
    return estimates.unionByName(later, allowMissingColumns=True)


def overlap_check(
    estimates: DataFrame, projections: DataFrame, common_year: int, dims: Dims = POPULATION
) -> DataFrame:
    """Distinct rows of the common year that only one side has, with that side.

    One aggregation finds both directions, and treats nulls as equal like a set difference does.
    """
    keys = [*[c for c in dims.keys if c in estimates.columns], dims.value]
    sides = [
        df.filter(F.col(dims.year) == common_year).select(*keys, F.lit(estimate).alias("_estimate"))
        for df, estimate in ((estimates, True), (projections, False))
    ]
    return one_sided_rows(sides[0].unionByName(sides[1]), keys)


def one_sided_rows(rows: DataFrame, keys: list[str], estimate: str = "_estimate") -> DataFrame:
    """Distinct keys that occur with one value of the boolean `estimate` only, with that side."""
    return (
        rows.groupBy(*keys)
        .agg(F.max(estimate).alias("_any"), F.min(estimate).alias("_all"))
        .filter(F.col("_any") == F.col("_all"))
        .select(*keys, F.when(F.col("_any"), "estimates").otherwise("projections").alias("side"))
    )
