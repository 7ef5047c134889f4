"""Code lists, rule tables and stored cubes."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table, pruned to `columns`."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_rules(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    **equal: str,
) -> DataFrame:
    """Rows of a rule table whose columns equal the given values, e.g. `var_type="area"`."""
    for name, value in equal.items():
        table = table.filter(F.col(name) == value)
    if where is not None:
        table = table.filter(where)
    return table.select(*columns) if columns else table


def read_cube(spark: SparkSession, path: str, year: str = "timePointYears") -> DataFrame:
    """Cube stored by year; year conditions prune whole folders.

    The schema is taken from the files, so codes with leading zeros stay text.
    """
    return spark.read.parquet(path).withColumn(year, F.col(year).cast("int"))


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small rule table written in code.

    It becomes a local relation, whose exact size lets Catalyst decide on a broadcast.
    """
    types = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(types)
    columns = [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), types)
