"""Wide published tables to the source cube."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycube.functions import clean_number
from tallycube.operators.metadata import build_metadata, release_texts
from tallycube.operators.reshape import fill_missing, melt_years
from tallycube.operators.select import known_codes, unknown_codes
from tallycube.operators.splice import one_sided_rows, overlap_check, splice
from tallycube.schema import ELEMENT_OF_ROLE, FIRST_YEAR, FLAG_IMPORTED, METHOD_IMPORTED, POPULATION, Dims
from tallycube.sources.wide import discover_columns, files_by_role, read_folder, read_wide

# {role: {"estimates": wide table, "medium": wide table or absent}}
Sections = Mapping[str, Mapping[str, DataFrame]]


@dataclass(frozen=True)
class Ingest:
    cube: DataFrame
    metadata_texts: DataFrame
    unknown: DataFrame
    overlaps: DataFrame

    def metadata(self) -> DataFrame:
        """Numbered metadata; the numbering runs a job of its own."""
        return build_metadata(self.metadata_texts)


def long_series(wide: DataFrame, first_year: int, dims: Dims = POPULATION) -> DataFrame:
    """(Variant, area, year, value) of one wide table, found by its header."""
    variant, area, years = discover_columns(wide.columns, first_year)
    columns = [F.col(f"`{y}`") for y in years]
    kind = F.col(f"`{variant}`") if variant else F.lit(None).cast("string")
    picked = wide.select(kind.alias("Variant"), F.col(f"`{area}`").cast("string").alias(dims.area), *columns)
    return melt_years(picked, ["Variant", dims.area], years, dims)


def read_sections(spark: SparkSession, folder: str) -> dict[str, dict[str, DataFrame]]:
    """All input tables below a folder, by role and section."""
    return {
        role: {section: read_wide(spark, paths) for section, paths in sections.items()}
        for role, sections in files_by_role(spark, folder).items()
    }


def long_sections(
    sections: Sections, common_year: int, first_year: int = FIRST_YEAR, dims: Dims = POPULATION
) -> tuple[DataFrame, DataFrame | None]:
    """Estimates and projections of all roles as long tables with their element."""
    sides: dict[str, list[DataFrame]] = {"estimates": [], "medium": []}
    for role, element in ELEMENT_OF_ROLE.items():
        for section, wide in sections.get(role, {}).items():
            start = first_year if section == "estimates" else common_year
            sides[section].append(long_series(wide, start, dims).withColumn(dims.element, F.lit(element)))
    union = {k: reduce(DataFrame.unionByName, v) if v else None for k, v in sides.items()}
    return union["estimates"], union["medium"]


def ingest(
    sections: Sections,
    codes: DataFrame,
    common_year: int,
    prospects: str = "WPP",
    urbanization: str = "WUP",
    first_year: int = FIRST_YEAR,
    dims: Dims = POPULATION,
) -> Ingest:
    """Source cube, metadata, unknown codes and overlap differences of one release."""
    estimates, medium = long_sections(sections, common_year, first_year, dims)
    rows = estimates if medium is None else splice(estimates, medium, common_year, dims)
    # Only roles that have both sections can disagree.
    both = [ELEMENT_OF_ROLE[r] for r, found in sections.items() if {"estimates", "medium"} <= set(found)]
    compared = estimates.filter(F.col(dims.element).isin(both) if both else F.lit(False))
    overlaps = overlap_check(compared, compared if medium is None else medium.filter(F.col(dims.element).isin(both)), common_year, dims)
    return _release(rows, overlaps, codes, prospects, urbanization, dims)


def ingest_folder(
    spark: SparkSession,
    folder: str,
    codes: DataFrame,
    common_year: int,
    prospects: str = "WPP",
    urbanization: str = "WUP",
    first_year: int = FIRST_YEAR,
    dims: Dims = POPULATION,
) -> Ingest:
    """The same from all tables below a folder, each output in one scan of the files."""
    texts = read_folder(spark, folder, common_year, first_year, dims)
    long = texts.withColumn(dims.value, clean_number(dims.value))
    estimate, common = F.col("section") == "estimates", F.col(dims.year) == common_year
    # Only elements that have both sections can disagree; this table has a row for each element.
    roles = long.filter(common).groupBy(dims.element).agg(F.count_distinct("section").alias("n")).filter("n = 2").select(dims.element)
    compared = long.filter(common).withColumn("_estimate", estimate).join(roles, dims.element, "left_semi")
    rows = long.filter(estimate | ~common).drop("section")
    return _release(rows, one_sided_rows(compared, [*dims.keys, dims.value]), codes, prospects, urbanization, dims)


def _release(rows: DataFrame, overlaps: DataFrame, codes: DataFrame, prospects: str, urbanization: str, dims: Dims) -> Ingest:
    flagged = rows.withColumns({dims.status: F.lit(FLAG_IMPORTED), dims.method: F.lit(METHOD_IMPORTED)})
    known = known_codes(flagged, codes, dims)
    return Ingest(
        cube=fill_missing(known.select(*dims.columns), dims),
        metadata_texts=release_texts(known, prospects, urbanization, dims=dims),
        unknown=unknown_codes(rows, codes, dims),
        overlaps=overlaps,
    )
