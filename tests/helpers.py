"""Small cubes and row lists for the tests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallycube.operators.reshape import to_edge
from tallycube.sources import literal_table

CUBE = "geographicAreaM49 string, measuredElement string, timePointYears int, Value decimal(28,6), flagObservationStatus string, flagMethod string"
ITEM_CUBE = (
    "geographicAreaM49 string, measuredElement string, measuredItemCPC string, timePointYears int, "
    "Value decimal(28,6), flagObservationStatus string, flagMethod string"
)


def number(value):
    return None if value is None else Decimal(str(value))


def cube(spark: SparkSession, *rows) -> DataFrame:
    """(area, element, year, value[, status[, method]])."""
    full = [(*r[:3], number(r[3]), *(r[4:] or ("X",)), *(("h",) if len(r) < 6 else ())) for r in rows]
    return literal_table(spark, full, CUBE)


def item_cube(spark: SparkSession, *rows) -> DataFrame:
    """(area, element, item, year, value[, status])."""
    full = [(*r[:4], number(r[4]), r[5] if len(r) > 5 else "X", "h") for r in rows]
    return literal_table(spark, full, ITEM_CUBE)


def table(spark: SparkSession, schema: str, *rows) -> DataFrame:
    return literal_table(spark, rows, schema)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Sorted rows with plain numbers."""
    picked = to_edge(df.select(*columns) if columns else df)
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
