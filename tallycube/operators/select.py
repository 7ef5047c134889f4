"""Slices, validity, code-list and crosswalk filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycube.operators.joins import apart, drop_listed, keep_listed
from tallycube.schema import POPULATION, Dims

Keys = DataFrame | Sequence | None


def slice_cube(
    df: DataFrame,
    areas: Keys = None,
    elements: Keys = None,
    years: Keys = None,
    items: Keys = None,
    dims: Dims = POPULATION,
) -> DataFrame:
    """Cube slice by key sets; None means all keys of that dimension.

    Lists become pushed-down IN filters with keys of the column's type, and year filters prune the folders of a stored
    cube. A DataFrame (column `code`) becomes a semi join; a list too long for a filter is best given as one.
    """
    for column, keys in ((dims.year, years), (dims.element, elements), (dims.item, items), (dims.area, areas)):
        if keys is None:
            continue
        if isinstance(keys, DataFrame):
            df = keep_listed(df, keys, column)
        elif isinstance(keys, range) and keys.step == 1 and len(keys):
            df = df.filter(F.col(column).between(keys.start, keys.stop - 1))
        else:
            kind = df.schema[column].dataType
            df = df.filter(F.col(column).isin(*[F.lit(k).cast(kind) for k in keys]))
    return df


def codes_of(
    codes: DataFrame,
    types: Sequence[str] | None = None,
    selectable: bool | None = None,
    current: bool = False,
) -> DataFrame:
    """Code list restricted by type, by `selectionOnly` and to codes without an end date."""
    if types is not None:
        codes = codes.filter(F.col("type").isin(list(types)))
    if selectable is not None:
        codes = codes.filter(F.col("selectionOnly") != F.lit(selectable))
    if current:
        codes = codes.filter(F.col("endDate").isNull())
    return codes


def session_keys(
    mode: str,
    areas: Keys,
    items: Keys,
    area_codes: DataFrame,
    item_codes: DataFrame | None = None,
) -> tuple[Keys, Keys]:
    """Area and item keys an aggregation mode reads: those of the session, or all of a dimension."""
    countries = codes_of(area_codes, types=["country"])
    if mode.startswith("adhoc"):
        return areas, items
    return (
        countries if mode in ("area", "area_item") else areas,
        item_codes if mode in ("item", "area_item") else items,
    )


def disjoint_spans(spans: Column) -> Column:
    """Intervals (start_year, end_year; null for no bound) of one area in order, with those that overlap or touch as one."""
    first, last = F.lit(-(1 << 31)).cast("int"), F.lit((1 << 31) - 1).cast("int")
    closed = F.transform(spans, lambda x: F.struct(F.coalesce(x["start_year"], first).alias("s"), F.coalesce(x["end_year"], last).alias("e")))
    sorted_ = F.array_sort(F.filter(closed, lambda x: x["s"] <= x["e"]))
    head, none = F.struct(first.alias("s"), first.alias("e")), F.lit(False)

    def step(state: Column, x: Column) -> Column:
        # The interval that still grows, and those before it.
        touches = state["open"] & (x["s"] <= F.when(state["now"]["e"] == last, last).otherwise(state["now"]["e"] + 1))
        grown = F.struct(state["now"]["s"].alias("s"), F.greatest(state["now"]["e"], x["e"]).alias("e"))
        done = F.when(state["open"] & ~touches, F.concat(state["done"], F.array(state["now"]))).otherwise(state["done"])
        return F.struct(F.when(touches, grown).otherwise(x).alias("now"), F.lit(True).alias("open"), done.alias("done"))

    start = F.struct(head.alias("now"), none.alias("open"), F.slice(F.array(head), 1, 0).alias("done"))
    merged = F.aggregate(sorted_, start, step, lambda s: F.when(s["open"], F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]))
    bound = lambda c, open_: F.when(c != open_, c)
    return F.transform(merged, lambda x: F.struct(bound(x["s"], first).alias("start_year"), bound(x["e"], last).alias("end_year")))


def disjoint_validity(validity: DataFrame) -> DataFrame:
    """(m49, start_year, end_year) with the intervals of an area made disjoint; an area has few of them."""
    years = [F.col(c).cast("int").alias(c) for c in ("start_year", "end_year")]
    spans = validity.filter("m49 is not null").groupBy("m49").agg(F.collect_list(F.struct(*years)).alias("spans"))
    return spans.select("m49", F.explode(disjoint_spans(F.col("spans"))).alias("x")).select("m49", "x.*")


def within(year: Column, span: Column) -> Column:
    """Whether a year lies in an interval (start_year, end_year), null bounds being open."""
    return (span["start_year"].isNull() | (year >= span["start_year"])) & (span["end_year"].isNull() | (year <= span["end_year"]))


def valid_area_years(df: DataFrame, validity: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Rows inside at least one validity interval (m49, start_year, end_year) of their area.

    A null bound is open; an area without an interval is dropped. As the intervals of an area are disjoint, a row meets
    one of them at most, and an inner join will do.
    """
    spans = apart(disjoint_validity(validity), "m49").select(F.col("m49").alias(dims.area), F.struct("start_year", "end_year").alias("_span"))
    return df.join(spans, dims.area).filter(within(F.col(dims.year).cast("int"), F.col("_span"))).select(*df.columns)


def known_codes(df: DataFrame, codes: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    return keep_listed(df, codes, dims.area)


def unknown_codes(df: DataFrame, codes: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Distinct area codes that are not in the code list."""
    return drop_listed(df.select(dims.area).distinct(), codes, dims.area)


def country_only(df: DataFrame, codes: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Rows of areas listed as ordinary countries that carry a description."""
    countries = codes_of(codes, types=["country"], selectable=True)
    return keep_listed(df, countries.filter(F.col("description").isNotNull()), dims.area)


def compliant_only(df: DataFrame, crosswalk: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Rows of areas whose crosswalk entry is compliant."""
    return keep_listed(df, crosswalk.filter(F.col("compliant")), dims.area)


def year_bounds(df: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    return df.agg(F.min(dims.year).alias("start_year"), F.max(dims.year).alias("end_year"))


def head_rows(df: DataFrame, n: int, dims: Dims = POPULATION) -> DataFrame:
    """First rows in key order; each task keeps n rows at most."""
    return df.orderBy(*dims.keys).limit(n)


def without_areas(df: DataFrame, codes: Sequence[str], dims: Dims = POPULATION) -> DataFrame:
    """Leave out aliases that would be counted twice in a total."""
    return df.filter(~F.col(dims.area).isin(list(codes)))
