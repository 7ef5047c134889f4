"""Wide and long forms, fills, aliases, recodes, labels and row numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycube.functions import clean_number, clean_year
from tallycube.schema import FLAG_MISSING, POPULATION, VALUE_TYPE, Dims


def melt_years(df: DataFrame, ids: Sequence[str], years: Sequence[str], dims: Dims = POPULATION) -> DataFrame:
    """One row per id and year; empty cells are kept as null."""
    # unpivot wants one type for all cells, and number cleaning starts from text.
    texts = df.select(*ids, *[F.col(f"`{y}`").cast("string").alias(y) for y in years])
    return texts.unpivot(list(ids), list(years), dims.year, dims.value).select(
        *ids,
        clean_year(dims.year).alias(dims.year),
        clean_number(dims.value).alias(dims.value),
    )


def pivot_elements(df: DataFrame, ids: Sequence[str], elements: Sequence[str], dims: Dims = POPULATION) -> DataFrame:
    """One row per id, one column per element. The element list is given, so no extra job looks for it."""
    return df.groupBy(*ids).agg(
        *[F.max(F.when(F.col(dims.element) == e, F.col(dims.value))).alias(e) for e in elements]
    )


def fill_missing(df: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Missing values become 0 with status `O`; both columns look at the value as it came in."""
    gap = F.col(dims.value).isNull()
    return df.withColumns(
        {
            dims.value: F.when(gap, F.lit(0).cast(df.schema[dims.value].dataType)).otherwise(F.col(dims.value)),
            dims.status: F.when(gap, FLAG_MISSING).otherwise(F.col(dims.status)),
        }
    )


def set_by(column: str, values: Mapping[str, str], by: str) -> Column:
    """Constant chosen by the code in column `by`; other codes keep the column."""
    chain = F.col(column)
    for code, value in values.items():
        chain = F.when(F.col(by) == code, value).otherwise(chain)
    return chain


def alias_area(df: DataFrame, aliases: Mapping[str, Sequence[str]], area: str = POPULATION.area) -> DataFrame:
    """Repeat the rows of an area under further codes, in one scan of the input."""
    code = F.col(area)
    copies = F.array(code)
    for source, targets in aliases.items():
        copies = F.when(code == source, F.array(code, *map(F.lit, targets))).otherwise(copies)
    return df.withColumn(area, F.explode(copies)).select(*df.columns)


def recode(df: DataFrame, column: str, mapping: DataFrame | Mapping[str, str], keep_unmapped: bool = True) -> DataFrame:
    """Replace codes by a mapping: a dict, or a table (old, new) with unique old codes.

    Codes without a mapping stay, or their rows go with `keep_unmapped=False`.
    """
    if isinstance(mapping, Mapping):
        kept = df if keep_unmapped else df.filter(F.col(column).isin(list(mapping)))
        return kept.withColumn(column, set_by(column, mapping, column))
    pairs = mapping.select(F.col("old").alias(column), F.col("new").alias("_new"))
    return (
        df.join(pairs, column, "left" if keep_unmapped else "inner")
        .withColumn(column, F.coalesce("_new", column))
        .select(*df.columns)
    )


def add_labels(df: DataFrame, codelists: Mapping[str, DataFrame]) -> DataFrame:
    """Add `<column>_description` for each coded column with a code list (code, description)."""
    for column, codes in codelists.items():
        labels = codes.select(F.col("code").alias(column), F.col("description").alias(f"{column}_description"))
        df = df.join(labels, column, "left")
    return df


def unlabelled(df: DataFrame, column: str) -> DataFrame:
    """Distinct codes that found no label in `add_labels`."""
    return df.filter(F.col(f"{column}_description").isNull()).select(column).distinct()


def with_row_id(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..n in the given order, nulls first, without one task seeing them all.

    Copies that agree in all of `order` get consecutive numbers, in an order of their own. No job runs here.
    """
    return running_total(df, order, name).withColumn(name, F.col(name) + 1)


def running_total(df: DataFrame, order: Sequence[str], name: str, weight: str | None = None) -> DataFrame:
    """Add the sum of `weight` (one for each row, unless named) over the rows that come earlier in the order.

    Rows are dealt to ranges between fixed bounds: keys of the rows with the smallest hashes, so that the bounds depend
    on the data alone and come out the same when a lost part is computed again. A running sum over the ranges (as many as
    spark.sql.shuffle.partitions, at most) shifts the sums inside each. Rows that agree in the whole order share a range.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(f"`{c}`") for c in order])
    bounds = _range_bounds(df.select(key.alias("k")), ranges)
    # Binary search: how many bounds lie below the key. Beyond the last bound the comparison is null.
    # The bounds are one row, joined to all others; as a scalar subquery they would be planned anew for each step.
    dealt = df.join(F.broadcast(bounds)).withColumn("_range", F.lit(0))
    for step in (1 << k for k in reversed(range(ranges.bit_length()))):
        below = F.get("_bounds", F.col("_range") + (step - 1)) < key
        dealt = dealt.withColumn("_range", F.col("_range") + F.when(below, step).otherwise(0))
    dealt = dealt.drop("_bounds").repartition("_range")
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    sizes = dealt.groupBy("_range").agg(F.sum(one).alias("_n"))
    # One row per range, so a single task for this running sum is small at any data size.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*[F.col(f"`{c}`") for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_within", F.coalesce(F.sum(one).over(within), F.lit(0)))
        # A range has one row of 12 bytes here, and there are spark.sql.shuffle.partitions of them at most.
        .join(F.broadcast(before), "_range")
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_range", "_within", "_before")
    )


SAMPLED = 64  # one key in so many may become a bound
KEYS_PER_RANGE = 16


def _range_bounds(keys: DataFrame, ranges: int) -> DataFrame:
    """One row with the sorted bounds of `ranges` ranges of about equal size, as `_bounds`: an array of the structs `k`.

    The candidates are a sample by hash: of each of a fixed number of hash classes the key with the smallest hash.
    """
    hashed = keys.withColumn("h", F.xxhash64("k")).filter(F.pmod("h", F.lit(SAMPLED)) == 0)
    classes = F.pmod(F.shiftright("h", 6), F.lit(KEYS_PER_RANGE * ranges))
    sample = hashed.groupBy(classes.alias("c")).agg(F.min_by("k", "h").alias("k"))
    sorted_ = F.array_sort(F.collect_list("k"))
    step = F.greatest(F.lit(1), F.ceil(F.size("s") / F.lit(ranges)).cast("int"))
    picked = F.filter("s", lambda _, i: (i % step == step - 1) & (i < F.size("s") - 1))
    return sample.agg(sorted_.alias("s")).select(picked.alias("_bounds"))


def to_edge(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for consumers outside the library."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def to_cube_value(df: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    return df.withColumn(dims.value, F.col(dims.value).cast(VALUE_TYPE))
