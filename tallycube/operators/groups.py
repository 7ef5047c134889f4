"""Rule tables of the group aggregation: memberships, factors, dissemination, calculated elements."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycube.operators.joins import apart, drop_listed, keep_listed
from tallycube.schema import ADHOC_CODE, FACTOR_TYPE, POPULATION, VALUE_TYPE, Dims

# Elements whose amounts are never multiplied by a group factor, ratio definitions
# that are not used, and rule domains left out of the dissemination lists.
UNFACTORED_ELEMENTS = ("5622", "5922")
UNUSED_DENOMINATORS = ("5319",)
UNUSED_RESULTS = ("664",)
EXCLUDED_DOMAINS = (
    "Trade Flow",
    "Trade Indices",
    "Detailed trade matrix",
    "Production Indices",
    "Value of Agricultural Production",
)
FULL_DISSEMINATION = 99


def clean_members(groups: DataFrame) -> DataFrame:
    """Membership pairs (group_code, member_code) without copies, nulls and nested groups."""
    pairs = groups.select("group_code", "member_code").dropna("any")
    return drop_listed(pairs.distinct(), group_codes(pairs), "member_code", "group_code")


def group_codes(groups: DataFrame) -> DataFrame:
    """Each group code once. Memberships repeat a code for each member: a list of those grows with the members, a world group
    is a hot key of it, and the other side of a join is shuffled to meet it; codes alone are mostly few enough to be broadcast."""
    return apart(groups.select("group_code").distinct(), "group_code")


def first_of_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in `order`; partial minima instead of a window over the key."""
    rest = [c for c in df.columns if c not in key and c not in order]
    first = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*key, "_first.*").select(*df.columns)


def later_copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many rows of each key come after its first one; keys without copies are left out."""
    return df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("copies")).filter("copies > 0")


def mark_later(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """All rows, with `later`: false for one row of each key, the first in `order` and then by the other columns.

    Equal rows are counted, the first of each key is a partial minimum joined back, and the counts are spelt out again;
    a window would bring all rows of a key to one task. Null keys are keys like others.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    # The key columns stand in the order too, so that there is one even if the key is all.
    rank = F.struct(*order, *rest, *[c for c in key if c not in order])
    first = counted.groupBy(*[F.col(c).alias(f"_key_{c}") for c in key]).agg(F.min(rank).alias("_least"))
    same = reduce(lambda a, b: a & b, [counted[c].eqNullSafe(first[f"_key_{c}"]) for c in key])
    copies = counted.join(first, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    later = ~((rank == F.col("_least")) & (F.col("_copy") == 1))
    return copies.select(*[counted[c] for c in df.columns], later.alias("later"))


def item_factors(groups: DataFrame) -> DataFrame:
    """Largest factor of each (group_code, member_code)."""
    return groups.groupBy("group_code", "member_code").agg(F.max(held_factor("factor")).alias("factor"))


def held_factor(factor: str) -> Column:
    """A factor in its type; one with more digits than the type holds is an error.

    A double is taken with the digits it is written with: one third is 0.3333333333333333.
    """
    given, held = F.col(factor).cast("double"), F.col(factor).try_cast(FACTOR_TYPE)
    lost = F.raise_error(F.concat(F.lit("factor does not fit its type: "), F.col(factor).cast("string"))).cast(FACTOR_TYPE)
    return F.when(F.col(factor).isNotNull(), F.when(held.cast("double") == given, held).otherwise(lost))


def or_one(factor: str | Column) -> Column:
    """A missing factor is 1."""
    return F.coalesce(factor, F.lit(1).cast(FACTOR_TYPE))


def attach_factor(df: DataFrame, factors: DataFrame, dims: Dims, how: str = "left") -> DataFrame:
    """Attach item groups (item_group_code) and the multiplier `_factor` of each row.

    Some elements are never multiplied. An item in several groups gives one row per group; with a left
    join, items in no group stay.
    """
    members = factors.select(
        F.col("member_code").alias(dims.item), F.col("group_code").alias("item_group_code"), "factor"
    )
    return df.join(members, dims.item, how).withColumn("_factor", factor_of(dims)).drop("factor")


def factor_of(dims: Dims, factor: str = "factor") -> Column:
    """The multiplier of a row: 1 for some elements and for a missing factor."""
    unfactored = F.col(dims.element).isin(*UNFACTORED_ELEMENTS)
    return F.when(unfactored, F.lit(1).cast(FACTOR_TYPE)).otherwise(or_one(factor))


def product(value: str) -> Column:
    return (F.col(value).cast(VALUE_TYPE) * F.col("_factor")).cast("decimal(38,10)")


def apply_factor(df: DataFrame, factors: DataFrame, dims: Dims) -> DataFrame:
    """Values multiplied by the factor of each item group."""
    return attach_factor(df, factors, dims).withColumn(dims.value, product(dims.value)).drop("_factor")


def drop_existing_aggregates(
    df: DataFrame, area_groups: DataFrame | None = None, item_groups: DataFrame | None = None, dims: Dims = POPULATION
) -> DataFrame:
    """Remove rows whose area or item already is a group, or is the code of an ad hoc total; either table may be absent."""
    rows = df if area_groups is None else drop_listed(df, group_codes(area_groups), dims.area, "group_code")
    if dims.item and item_groups is not None:
        rows = drop_listed(rows, group_codes(item_groups), dims.item, "group_code")
        rows = rows.filter(F.col(dims.item).isNull() | (F.col(dims.item) != ADHOC_CODE))
    return rows


def disseminated(rules: DataFrame, full_only: bool = False) -> DataFrame:
    """Codes (column code) that take part in aggregation: flag known and not 0, or exactly 99.

    `rules` has domain_name, code and flag.
    """
    listed = rules.filter(~F.coalesce(F.col("domain_name").isin(*EXCLUDED_DOMAINS), F.lit(False)))
    wanted = F.col("flag") == FULL_DISSEMINATION if full_only else F.col("flag") != 0
    return listed.filter(wanted & F.col("code").isNotNull()).select("code").distinct()


def usable_ratios(
    calculated: DataFrame,
    unused_denominators: Sequence[str] = UNUSED_DENOMINATORS,
    unused_results: Sequence[str] = UNUSED_RESULTS,
) -> DataFrame:
    """Ratio definitions (result_var_code, num_var_code, den_var_code, mult) in use.

    Two different definitions of one result would mix in its sums, so they are an error.
    """
    parts = ("num_var_code", "den_var_code", "mult")
    used = calculated.filter(
        ~F.col("den_var_code").isin(list(unused_denominators)) & ~F.col("result_var_code").isin(list(unused_results))
    )
    single = used.select("result_var_code", F.struct(*parts).alias("d")).groupBy("result_var_code").agg(
        F.min("d").alias("d"), F.max("d").alias("other")
    )
    twice = F.raise_error(F.concat(F.lit("two definitions of the ratio "), F.col("result_var_code"))).cast("string")
    checked = F.when(F.col("d") == F.col("other"), F.col("result_var_code")).otherwise(twice)
    return single.select(checked.alias("result_var_code"), *[F.col(f"d.{c}").alias(c) for c in parts])


def expand_elements(requested: DataFrame, calculated: DataFrame) -> DataFrame:
    """Requested elements (column code) plus numerator and denominator of each requested ratio."""
    parts = keep_listed(usable_ratios(calculated), requested, "result_var_code").select(
        F.explode(F.array("num_var_code", "den_var_code")).alias("code")
    )
    return requested.select("code").union(parts).distinct()


def exclude_elements(df: DataFrame, excluded: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Drop the elements (column element_code) that must not be aggregated."""
    return drop_listed(df, excluded, dims.element, "element_code")


def excluded_elements(df: DataFrame, excluded: DataFrame, dims: Dims = POPULATION) -> DataFrame:
    """Which of the excluded elements occurred."""
    return keep_listed(df.select(dims.element).distinct(), excluded, dims.element, "element_code")
