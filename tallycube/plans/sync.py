"""Source cube to operational cube: compliant areas, residual areas, aliases, metadata, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.operators.coverage import coverage_report
from tallycube.operators.metadata import build_metadata, source_texts
from tallycube.operators.reshape import alias_area
from tallycube.operators.residual import RESIDUAL_PARENTS, gap_parents, missing_residual_codes, residual_areas
from tallycube.operators.select import compliant_only, slice_cube
from tallycube.schema import ELEMENTS, MALE, POPULATION, URBAN, Dims

# Areas stored under further codes.
ALIASES = {"156": ["1248"]}


@dataclass(frozen=True)
class Sync:
    cube: DataFrame
    metadata_texts: DataFrame
    report: DataFrame
    new_codes: DataFrame

    def metadata(self) -> DataFrame:
        """Numbered metadata; the numbering runs a job of its own."""
        return build_metadata(self.metadata_texts)


# The area column of the stored source, and the year that stands for no year.
SOURCE = Dims(area="geographicAreaM49_unpd")
NO_YEAR = "0"


def source_slice(
    stored: DataFrame,
    areas: DataFrame,
    years: DataFrame,
    elements: Sequence[str] = ELEMENTS,
    source: Dims = SOURCE,
    dims: Dims = POPULATION,
) -> DataFrame:
    """The part of a stored source that its code lists (column code, text) name, under the names of the operational cube.

    The list of years may hold `0`, which is no year and is left out.
    """
    wanted = years.filter(F.col("code") != NO_YEAR).select(F.col("code").cast("int").alias("code")).distinct()
    rows = slice_cube(stored, areas=areas.select("code").distinct(), elements=elements, years=wanted, dims=source)
    return rows.select(*[F.col(a).alias(b) for a, b in zip(source.columns, dims.columns, strict=True)])


def sync_slice(stored: DataFrame, areas: DataFrame, years: DataFrame, *args, source: Dims = SOURCE, dims: Dims = POPULATION, **named) -> Sync:
    """`sync` of a slice of the stored source; the other arguments are those of `sync`."""
    return sync(source_slice(stored, areas, years, source=source, dims=dims), *args, dims=dims, **named)


def sync(
    source: DataFrame,
    crosswalk: DataFrame,
    hierarchy: DataFrame,
    conversion: DataFrame,
    prospects_year: int,
    urbanization_year: int,
    flag_weights: DataFrame,
    known_parents: DataFrame | Sequence[str] = RESIDUAL_PARENTS,
    aliases: dict[str, list[str]] = ALIASES,
    dims: Dims = POPULATION,
) -> Sync:
    reporting = compliant_only(source, crosswalk, dims)
    residuals = residual_areas(source, reporting, hierarchy, conversion, flag_weights, dims=dims)
    cube = alias_area(reporting.select(*dims.columns).unionByName(residuals), aliases, dims.area)
    texts = source_texts(
        cube, prospects_year, urbanization_year, conversion.select(F.col("residual_code").alias("code")), dims
    )
    wanted = gap_parents(reporting, hierarchy, (MALE, URBAN), dims).select("parent").distinct()
    return Sync(cube, texts, coverage_report(reporting, dims=dims), missing_residual_codes(wanted, known_parents))
