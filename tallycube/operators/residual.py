"""Residual ("unspecified") areas: what a parent publishes beyond its reporting members."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.functions import base_code, blank_to_null, residual_code
from tallycube.operators.aggregate import rank_flags, ranked_flag
from tallycube.operators.coverage import TEXT_NEW_RESIDUAL, missing_areas
from tallycube.operators.joins import drop_listed
from tallycube.schema import FEMALE, MALE, POPULATION, RURAL, URBAN, Dims

# Parents that have a residual code, three digits with leading zeros.
RESIDUAL_PARENTS = ("011", "029", "005", "061", "154", "039", "021", "155", "057")


def parents(hierarchy: DataFrame) -> DataFrame:
    """(parent, member, level) of each lowest-level area: level 4 where it exists, else level 3.

    `hierarchy` is ragged, with code_l3, code_l4 (null or empty) and code_l5.
    """
    return hierarchy.select(
        F.coalesce(blank_to_null("code_l4"), "code_l3").alias("parent"),
        F.col("code_l5").alias("member"),
        F.when(blank_to_null("code_l4").isNull(), 3).otherwise(4).alias("level"),
    )


def gap_parents(
    cube: DataFrame, hierarchy: DataFrame, gap_elements: Sequence[str] = (MALE,), dims: Dims = POPULATION
) -> DataFrame:
    """(parent, gap) for parents with a member that reports a total but never the element `gap`."""
    gaps = missing_areas(cube, gap_elements, dims).select(
        F.col(dims.area).alias("member"), F.col(dims.element).alias("gap")
    )
    return parents(hierarchy).join(gaps, "member").select("parent", "gap").distinct()


def members_of(hierarchy: DataFrame, wanted: DataFrame, include_descendants: bool = False) -> DataFrame:
    """(parent, gap, member) of the wanted parents.

    A level-3 parent normally covers the members without a level 4; `include_descendants` adds the
    members below its level-4 areas, which the published value of the parent covers as well.
    """
    own = parents(hierarchy).select("parent", "member")
    if include_descendants:
        below = hierarchy.filter(blank_to_null("code_l4").isNotNull()).select(
            F.col("code_l3").alias("parent"), F.col("code_l5").alias("member")
        )
        own = own.unionByName(below)
    return own.distinct().join(wanted.select("parent", "gap").distinct(), "parent")


def missing_residual_codes(wanted: DataFrame, known: DataFrame | Sequence[str] = RESIDUAL_PARENTS) -> DataFrame:
    """Parents that need a residual but have no code for it, with the report text."""
    if isinstance(known, DataFrame):
        absent = drop_listed(wanted, known, "parent", "parent")
    else:
        absent = wanted.filter(F.col("parent").isNull() | ~F.col("parent").isin(list(known)))
    return absent.select("parent", F.concat(F.lit(TEXT_NEW_RESIDUAL), "parent").alias("message"))


def published_parents(
    source: DataFrame, conversion: DataFrame, elements: Sequence[str], dims: Dims = POPULATION
) -> DataFrame:
    """Published values under the parent code of the conversion table (source_code, residual_code)."""
    codes = conversion.select(F.col("source_code").alias(dims.area), base_code("residual_code").alias("parent"))
    return (
        source.filter(F.col(dims.element).isin(list(elements)))
        .join(codes, dims.area)
        .select("parent", dims.element, dims.year, F.col(dims.value).alias("published"))
    )


@dataclass(frozen=True)
class ResidualRule:
    """Elements whose residual is due where `gap` is missing, and how the residual is finished."""

    elements: tuple[str, ...]
    gap: str
    round_to: int | None = None
    drop_zero: bool = False


# Sexes are taken as they come, urban and rural figures rounded and without zeros.
RULES = (ResidualRule((MALE, FEMALE), MALE), ResidualRule((RURAL, URBAN), URBAN, round_to=6, drop_zero=True))


def residual_areas(
    source: DataFrame,
    reporting: DataFrame,
    hierarchy: DataFrame,
    conversion: DataFrame,
    flag_weights: DataFrame,
    rules: Sequence[ResidualRule] = RULES,
    include_descendants: bool = False,
    dims: Dims = POPULATION,
) -> DataFrame:
    """Published parent value minus the strict sum of its reporting members, as area `parent.01`.

    `source` is the cube with the published parents, `reporting` its compliant areas. Only parents
    with a gap get a residual; a missing residual is left out. All rules share one pass over the
    reporting areas for the gaps and one for the sums.
    """
    wanted = gap_parents(reporting, hierarchy, [r.gap for r in rules], dims)
    members = members_of(hierarchy, wanted, include_descendants).withColumnRenamed("member", dims.area)
    elements = [e for r in rules for e in r.elements]
    rule_of = F.lit(None).cast("string")
    for rule in rules:
        rule_of = F.when(F.col(dims.element).isin(*rule.elements), rule.gap).otherwise(rule_of)
    by = ["parent", dims.element, dims.year]
    available = (
        reporting.filter(F.col(dims.element).isin(elements)).withColumn("gap", rule_of).join(members, [dims.area, "gap"])
    )
    picked = (
        rank_flags(available, flag_weights, dims.status)
        .groupBy(*by, dims.method)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count(dims.value).alias("_known"),
            F.sum(dims.value).alias("_sum"),
            F.min("_rank").alias("_rank"),
        )
        .groupBy(*by)
        .agg(
            F.when(F.sum("_rows") == F.sum("_known"), F.sum("_sum")).alias("available"),
            F.min("_rank").alias("_rank"),
            F.min(dims.method).alias(dims.method),
        )
    )
    summed = ranked_flag(picked, flag_weights, dims.status)
    difference = F.col("published") - F.col("available")
    value, keep = difference, F.lit(True)
    for rule in rules:
        ours = F.col(dims.element).isin(*rule.elements)
        if rule.round_to is not None:
            value = F.when(ours, F.round(difference, rule.round_to)).otherwise(value)
        if rule.drop_zero:
            keep = keep & (~ours | (F.col(dims.value) != 0))
    return (
        summed.join(published_parents(source, conversion, elements, dims), by)
        .withColumn(dims.value, value)
        .filter(F.col(dims.value).isNotNull() & keep)
        .withColumn(dims.area, residual_code("parent"))
        .select(*dims.columns)
    )
