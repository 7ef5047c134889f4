"""Which areas report what: gaps, one-sided reporting, report texts, year coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.operators.joins import drop_listed, full_join
from tallycube.operators.select import codes_of
from tallycube.schema import FEMALE, MALE, POPULATION, RURAL, TOTAL, URBAN, Dims

# Texts of the coverage report.
TEXT_SEX = "Missing countries for male and female population: "
TEXT_SEX_END = "They will be included in the unspecified areas. "
TEXT_RURAL = "Missing rural countries: "
TEXT_URBAN = "Missing urban countries: "
TEXT_PLAIN_END = ". "
TEXT_ONE_SIDED = "Problem! Countries "
TEXT_ONE_SIDED_END = " are reporting only male or female population. "
TEXT_NEW_RESIDUAL = "A new 'unspecified area' code is required for area: "


def reported(df: DataFrame, elements: Sequence[str], dims: Dims = POPULATION) -> DataFrame:
    """One row per area with a boolean `has_<element>` for the total and each element, in one pass."""
    return df.groupBy(dims.area).agg(
        *[F.max(F.col(dims.element) == e).alias(f"has_{e}") for e in dict.fromkeys((TOTAL, *elements))]
    )


def missing_areas(
    df: DataFrame, elements: Sequence[str] = (MALE, FEMALE, URBAN, RURAL), dims: Dims = POPULATION
) -> DataFrame:
    """(element, area) for areas with a total in some year but the element in none."""
    gaps = F.array(*[F.when(~F.col(f"has_{e}"), F.lit(e)) for e in elements])
    return (
        reported(df, elements, dims)
        .filter(f"has_{TOTAL}")
        .select(dims.area, F.explode(F.array_compact(gaps)).alias(dims.element))
    )


def missing_cells(
    df: DataFrame, elements: Sequence[str] = (MALE, FEMALE, URBAN, RURAL), dims: Dims = POPULATION
) -> DataFrame:
    """(element, area, year) of totals whose element is missing in that very year."""
    cells = df.groupBy(dims.area, dims.year).agg(
        *[F.max(F.col(dims.element) == e).alias(f"has_{e}") for e in (TOTAL, *elements)]
    )
    gaps = F.array(*[F.when(~F.col(f"has_{e}"), F.lit(e)) for e in elements])
    return cells.filter(f"has_{TOTAL}").select(
        dims.area, dims.year, F.explode(F.array_compact(gaps)).alias(dims.element)
    )


def one_sided(df: DataFrame, left: str = MALE, right: str = FEMALE, dims: Dims = POPULATION) -> DataFrame:
    """Areas with a total and exactly one of two elements, with the one that is missing."""
    a, b = F.col(f"has_{left}"), F.col(f"has_{right}")
    return (
        reported(df, (left, right), dims)
        .filter(F.col(f"has_{TOTAL}") & (a != b))
        .select(dims.area, F.when(a, right).otherwise(left).alias("missing_element"))
    )


def coverage_report(df: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Report messages (kind, code, message) on gaps of the cube, one for each kind of gap and area.

    An element's gap list is given when its number of rows differs from that of the total, and one-sided
    areas always.
    """
    kinds = {MALE: "sex", RURAL: "rural", URBAN: "urban"}
    n = {e: F.count(F.when(F.col(dims.element) == e, 1)) for e in (TOTAL, *kinds)}
    # One row for the whole cube: which elements have another number of rows than the total.
    fires = df.agg(F.struct(*[(n[e] != n[TOTAL]).alias(name) for e, name in kinds.items()]).alias("f")).scalar()
    found = [F.when(~F.col(f"has_{e}") & fires[name], F.lit(name)) for e, name in kinds.items()]
    found.append(F.when(F.col(f"has_{MALE}") != F.col(f"has_{FEMALE}"), F.lit("one_sided")))
    lists = (
        reported(df, (*kinds, FEMALE), dims)
        .filter(f"has_{TOTAL}")
        .select(F.explode(F.array_compact(F.array(*found))).alias("kind"), F.col(dims.area).alias("code"))
    )
    texts = {
        "sex": (TEXT_SEX, TEXT_SEX_END),
        "rural": (TEXT_RURAL, TEXT_PLAIN_END),
        "urban": (TEXT_URBAN, TEXT_PLAIN_END),
        "one_sided": (TEXT_ONE_SIDED, TEXT_ONE_SIDED_END),
    }
    start, end = F.lit(""), F.lit("")
    for name, (head, tail) in texts.items():
        start = F.when(F.col("kind") == name, head).otherwise(start)
        end = F.when(F.col("kind") == name, tail).otherwise(end)
    return lists.select("kind", "code", F.concat(start, "code", end).alias("message"))


def country_year_coverage(df: DataFrame, codes: DataFrame, year: int, dims: Dims = POPULATION) -> DataFrame:
    """Totals of one year set against the current countries: both sides are kept whole."""
    totals = df.filter((F.col(dims.year) == year) & (F.col(dims.element) == TOTAL)).select(
        F.col(dims.area).alias("code"), dims.value
    )
    current = codes_of(codes, types=["country"], current=True).select("code", "description")
    return full_join(totals, current, ["code"])


def missing_countries(
    df: DataFrame, codes: DataFrame, validity: DataFrame, year: int, dims: Dims = POPULATION
) -> DataFrame:
    """Current countries without a total in that year, with their validity where known."""
    # Distinct first: a list taken from observations may repeat one code very often.
    present = df.filter((F.col(dims.year) == year) & (F.col(dims.element) == TOTAL)).select(dims.area).distinct()
    current = codes_of(codes, types=["country"], current=True).select("code", "description")
    absent = drop_listed(current, present, "code", dims.area)
    return absent.join(validity.withColumnRenamed("m49", "code"), "code", "left")
