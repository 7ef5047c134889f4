"""Aggregation of areas and items into groups: sums, ratios and flags, in six modes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycube.operators.groups import (
    disseminated,
    drop_existing_aggregates,
    exclude_elements,
    expand_elements,
    factor_of,
    item_factors,
    or_one,
    product,
    usable_ratios,
)
from tallycube.operators.joins import keep_listed
from tallycube.operators.select import disjoint_spans, valid_area_years, within
from tallycube.schema import ADHOC_CODE, FACTOR_TYPE, METHOD_AGGREGATE, POPULATION, VALUE_TYPE, WORLD_GROUP, Dims
from tallycube.session import stored
from tallycube.sources.tables import literal_table


@dataclass(frozen=True)
class Mode:
    """What an aggregation mode groups, and which rows it takes."""

    area_groups: bool
    item_groups: bool
    area_key: str | None  # "group", "own", or None for one ad hoc area
    item_key: str | None
    world_only: bool = False
    distinct_rows: bool = False
    lists: str | None = None  # "any" or "full" dissemination
    needs_item: bool = True


MODES = {
    "adhoc_area": Mode(True, False, None, "own", world_only=True, needs_item=False),
    "adhoc_item": Mode(False, True, "own", None, distinct_rows=True),
    "adhoc_area_item": Mode(True, True, None, None, world_only=True, distinct_rows=True),
    "area": Mode(True, False, "group", "own", lists="any", needs_item=False),
    "item": Mode(False, True, "own", "group", lists="any"),
    "area_item": Mode(True, True, "group", "group", lists="full"),
}


@dataclass(frozen=True)
class Rules:
    """Rule tables of one domain; the optional ones may be left out."""

    area_members: DataFrame | None = None  # group_code, member_code
    item_members: DataFrame | None = None  # group_code, member_code, factor
    validity: DataFrame | None = None  # m49, start_year, end_year
    calculated: DataFrame | None = None  # result_var_code, num_var_code, den_var_code, mult
    flag_weights: DataFrame | None = None  # flag, weight
    area_rules: DataFrame | None = None  # domain_name, code, flag
    item_rules: DataFrame | None = None
    excluded: DataFrame | None = None  # element_code


def aggregate(
    cube: DataFrame,
    mode: str,
    rules: Rules,
    elements: Sequence[str],
    dims: Dims = POPULATION,
    weakest: str = "min",
) -> DataFrame:
    """Group aggregates of a cube.

    `elements` are the requested ones; parts of requested ratios are added. Area modes drop rows with
    any missing column before summing, item modes sum what exists (all missing: 0).
    """
    plan = MODES[mode]
    if plan.needs_item and not dims.item:
        raise ValueError(f"mode {mode!r} needs an item dimension")
    rows = cube.select(*dims.columns)
    if rules.calculated is None:
        rows = rows.filter(F.col(dims.element).isin(list(elements)))
    else:
        requested = literal_table(cube.sparkSession, [(e,) for e in elements], "code string")
        rows = keep_listed(rows, expand_elements(requested, rules.calculated), dims.element)
    if plan.area_groups:
        rows = rows.dropna("any", subset=dims.columns)
    ratios = usable_ratios(rules.calculated) if rules.calculated is not None else None
    if ratios is not None:
        rows = rows.unionByName(ratio_parts(rows, ratios, dims), allowMissingColumns=True)
    # One join on each axis tells all that the rules say of a code. Rules judge area, item and year only, which ratio parts
    # share with their cell; so the parts are formed from narrow rows, and both meet the rules together.
    rows = _ruled(rows, dims.area, area_axis(rules, plan), "_area", plan, rules.area_rules is not None, rules.validity is not None, dims)
    if dims.item:
        rows = _ruled(rows, dims.item, item_axis(rules, plan), "_item", plan, rules.item_rules is not None, False, dims)
        if rules.item_members is not None:
            rows = rows.filter(F.col(dims.item).isNull() | (F.col(dims.item) != ADHOC_CODE))
    grouped = _with_groups(rows, plan, dims)
    keys = {
        "area": {"group": "group_code", "own": dims.area, None: None}[plan.area_key],
        "item": {"group": "item_group_code", "own": dims.item, None: None}[plan.item_key],
    }
    by = [k for k in (keys["area"], keys["item"], dims.year) if k]
    totals = group_rows(grouped, by, dims, ratios, rules.flag_weights, weakest)
    out = totals.filter(F.col(dims.value).isNotNull())
    for axis, column in (("area", dims.area), ("item", dims.item)):
        if not column:
            continue
        if keys[axis] is None:
            out = out.withColumn(column, F.lit(ADHOC_CODE))
        elif keys[axis] != column:
            out = out.withColumnRenamed(keys[axis], column)
        out = out.filter(F.col(column) != "NA")
    if rules.excluded is not None:
        out = exclude_elements(out, rules.excluded, dims)
    return out.select(*dims.columns)


def clean_rows(rows: DataFrame, rules: Rules, dims: Dims) -> DataFrame:
    """Observations of areas in their valid years that are not aggregates themselves."""
    if rules.validity is not None:
        rows = valid_area_years(rows, rules.validity, dims)
    pairs = rules.area_members
    if pairs is not None:
        pairs = pairs.select("group_code", "member_code").dropna("any")
    return drop_existing_aggregates(rows, pairs, rules.item_members, dims)


TAGGED = {"code": "string", "kind": "string", "ref": "string", "factor": FACTOR_TYPE, "start_year": "int", "end_year": "int"}


def _tagged(df: DataFrame, code: str, kind: str, **columns: Column) -> DataFrame:
    """Rows of one kind of rule, in the columns of all kinds."""
    given = columns | {"kind": F.lit(kind), "code": F.col(code)}
    return df.select(*[given.get(f, F.lit(None)).cast(t).alias(f) for f, t in TAGGED.items()]).filter("code is not null")


def _axis(parts: list[DataFrame], name: str) -> DataFrame | None:
    """One row for each code that a rule names: is_group, any, full (dissemination), spans (disjoint valid years), groups
    with their factor, and the distinct factors. Written and read back, so that its size is known and a hot code of the fact side can be split."""
    if not parts:
        return None
    of = lambda kind: F.col("kind") == kind
    years = F.struct("start_year", "end_year")
    rules = reduce(DataFrame.unionByName, parts).groupBy("code").agg(
        *[F.max(of(k)).alias(n) for k, n in (("group", "is_group"), ("any", "any"), ("full", "full"))],
        F.collect_list(F.when(of("span"), years)).alias("spans"),
        F.collect_set(F.when(of("member"), F.struct(F.col("ref").alias("group"), "factor"))).alias("groups"),
    )
    # Lambdas run here, once for each code: they have no generated code, and observations are many.
    factors = F.array_distinct(F.transform("groups", lambda x: or_one(x["factor"])))
    return stored(rules.withColumns({"spans": disjoint_spans(F.col("spans")), "factors": factors}), name)


def _lists(table: DataFrame | None, plan: Mode) -> list[DataFrame]:
    if table is None or not plan.lists:
        return []
    return [_tagged(disseminated(table, full_only=kind == "full"), "code", kind) for kind in ("any", "full")]


def area_axis(rules: Rules, plan: Mode) -> DataFrame | None:
    """Rules on areas: memberships, validity, dissemination, codes that are groups."""
    parts = _lists(rules.area_rules, plan)
    if rules.validity is not None:
        parts.append(_tagged(rules.validity, "m49", "span", start_year=F.col("start_year"), end_year=F.col("end_year")))
    if rules.area_members is not None:
        pairs = rules.area_members.select("group_code", "member_code").dropna("any")
        parts.append(_tagged(pairs, "group_code", "group"))
        members = pairs.filter(F.col("group_code") == WORLD_GROUP) if plan.world_only else pairs
        if plan.area_groups:
            parts.append(_tagged(members, "member_code", "member", ref=F.col("group_code")))
    return _axis(parts, "area-rules")


def item_axis(rules: Rules, plan: Mode) -> DataFrame | None:
    """Rules on items: groups with the largest factor, dissemination, codes that are groups."""
    parts = _lists(rules.item_rules, plan)
    if rules.item_members is not None:
        parts.append(_tagged(rules.item_members, "group_code", "group"))
        if plan.item_groups:
            parts.append(_tagged(item_factors(rules.item_members), "member_code", "member", ref=F.col("group_code"), factor=F.col("factor")))
    return _axis(parts, "item-rules")


def _ruled(
    rows: DataFrame, column: str, axis: DataFrame | None, name: str, plan: Mode, lists: bool, spans: bool, dims: Dims
) -> DataFrame:
    """Rows that the rules on one axis let pass, with the groups of their code in `name` (or their factors, if no more is asked)."""
    if axis is None:
        return rows
    marks = F.struct("is_group", "any", "full", "spans").alias("_marks")
    told = axis.select(F.col("code").alias(column), marks, F.col("factors" if name == "_item" and plan.distinct_rows else "groups").alias(name))
    rows = rows.join(told, column, "inner" if spans else "left").filter(~F.coalesce(F.col("_marks.is_group"), F.lit(False)))
    if spans:
        # A row lies in one of an area's disjoint intervals at most.
        spelt = rows.withColumn("_span", F.explode("_marks.spans"))
        rows = spelt.filter(within(F.col(dims.year).cast("int"), F.col("_span"))).drop("_span")
    # An empty list restricts nothing.
    if lists and plan.lists and not axis.filter("any").isEmpty():
        rows = rows.filter(F.coalesce(F.col(f"_marks.{plan.lists}"), F.lit(False)))
    return rows.drop("_marks")


def ratio_parts(rows: DataFrame, ratios: DataFrame, dims: Dims) -> DataFrame:
    """Numerator and denominator of each cell (area, item, year) that has both.

    They leave as rows of the part elements, tagged with the ratio they belong to, so group factors
    apply to them like to any other row.
    """
    cell = [c for c in (dims.area, dims.item, dims.year) if c]
    codes = {"num": "num_var_code", "den": "den_var_code"}
    roles = ratios.select(
        F.col("result_var_code").alias("_result"),
        F.explode(F.array(*[F.struct(F.col(c).alias(dims.element), F.lit(r).alias("_role")) for r, c in codes.items()])).alias("_part"),
    ).select("_result", "_part.*")
    cells = (
        rows.select(*cell, dims.element, dims.value)
        .join(roles, dims.element)
        .groupBy(*cell, "_result")
        .agg(*[F.sum(F.when(F.col("_role") == r, F.col(dims.value))).alias(f"_{r}") for r in codes])
    )
    both = cells.filter(F.col("_num").isNotNull() & F.col("_den").isNotNull())
    # A ratio has one definition, so its codes need not travel with the cells.
    amount = F.when(F.col("_role") == "num", F.col("_num")).otherwise(F.col("_den")).cast(VALUE_TYPE)
    return both.join(roles, "_result").select(*cell, "_result", dims.element, amount.alias(dims.value), "_role")


def group_rows(
    rows: DataFrame,
    by: Sequence[str],
    dims: Dims,
    ratios: DataFrame | None = None,
    flag_weights: DataFrame | None = None,
    weakest: str = "min",
) -> DataFrame:
    """Lenient sums, ratios and picked flags per `by` and element.

    Rows with `_result` are ratio parts, the others observations; `_factor` multiplies either. All of
    it is one hash aggregation, whose partial sums shrink the data before its shuffle.
    """
    has_parts = "_result" in rows.columns
    amount = product(dims.value) if "_factor" in rows.columns else F.col(dims.value)
    # An observation belongs to its own element, a ratio part to the element of the ratio.
    target = F.coalesce("_result", dims.element) if has_parts else F.col(dims.element)
    own = F.col("_result").isNull() if has_parts else F.lit(True)
    tagged = rows.withColumn("_target", target)
    picked = []
    if dims.status:
        tagged = rank_flags(tagged, flag_weights, dims.status, weakest)
        picked = [F.min(F.when(own, F.col("_rank"))).alias("_rank")]
    totals = tagged.groupBy(*by, "_target").agg(
        F.sum(F.when(own, amount)).alias("_sum"),
        F.count(F.when(own, 1)).alias("_rows"),
        *[F.sum(F.when(F.col("_role") == r, amount)).alias(f"_{r}") for r in ("num", "den") if has_parts],
        *picked,
    )
    # Ratio parts alone do not make a ratio: the element itself must have been observed.
    totals = totals.filter(F.col("_rows") > 0).withColumnRenamed("_target", dims.element)
    value = F.coalesce(F.col("_sum"), F.lit(0)).cast("double")
    if ratios is not None:
        mult = ratios.select(
            F.col("result_var_code").alias(dims.element), F.col("mult").cast("double"), F.lit(True).alias("_ratio")
        )
        ratio = F.try_divide(F.col("_num").cast("double"), F.col("_den").cast("double")) * F.col("mult")
        totals = totals.join(mult, dims.element, "left")
        value = F.when(F.col("_ratio"), ratio).otherwise(value)
    if dims.status:
        totals = ranked_flag(totals, flag_weights, dims.status, weakest)
    flags = {c: F.lit(METHOD_AGGREGATE) for c in (dims.method, dims.flag) if c}
    return totals.withColumn(dims.value, value).withColumns(flags).select(*by, dims.element, dims.value, *dims.flags)


def flag_ranks(weights: DataFrame | None, status: str, weakest: str = "min") -> DataFrame:
    """(status, _rank): flags by weight, ties in text order; a null flag is the empty one.

    The choice of a flag thus becomes a minimum of integers, which stays in hash aggregation.
    """
    if weights is None or weakest not in ("min", "max"):
        raise ValueError("picking a flag needs a weight table and a rule, 'min' or 'max'")
    weight = F.col("weight") if weakest == "min" else -F.col("weight")
    # A flag listed twice, or as null and as empty, still has one rank.
    flags = weights.groupBy(F.coalesce("flag", F.lit("")).alias(status)).agg(F.min(weight).alias("_w"))
    # One task sorts the table of flags, which has as many rows as there are flags.
    return flags.select(status, F.row_number().over(Window.orderBy("_w", status)).alias("_rank"))


def rank_flags(df: DataFrame, weights: DataFrame | None, status: str, weakest: str = "min") -> DataFrame:
    """Add `_rank`; a flag without a weight has none and is never picked."""
    ranks = flag_ranks(weights, status, weakest)
    return df.withColumn(status, F.coalesce(status, F.lit(""))).join(ranks, status, "left")


def ranked_flag(df: DataFrame, weights: DataFrame | None, status: str, weakest: str = "min") -> DataFrame:
    """Turn `_rank` back into the flag."""
    return df.join(flag_ranks(weights, status, weakest), "_rank", "left").drop("_rank")


def aggregate_flags(
    df: DataFrame, by: Sequence[str], weights: DataFrame, dims: Dims = POPULATION, weakest: str = "min"
) -> DataFrame:
    """Picked status and method `x` per key."""
    ranked = rank_flags(df.select(*by, dims.status), weights, dims.status, weakest)
    picked = ranked.groupBy(*by).agg(F.min("_rank").alias("_rank"))
    flagged = ranked_flag(picked, weights, dims.status, weakest)
    return flagged.select(*by, dims.status, F.lit(METHOD_AGGREGATE).alias(dims.method))


def aggregate_ratio(rows: DataFrame, by: Sequence[str], ratios: DataFrame, dims: Dims) -> DataFrame:
    """Only the ratio elements, per `by` (some of area, item and year)."""
    # Of the observations only those of a ratio element tell anything.
    own = keep_listed(rows, ratios, dims.element, "result_var_code")
    both = own.unionByName(ratio_parts(rows, ratios, dims), allowMissingColumns=True)
    return group_rows(both, by, replace(dims, status=None, method=None, flag=None), ratios).dropna(subset=[dims.value])


def _with_groups(rows: DataFrame, plan: Mode, dims: Dims) -> DataFrame:
    """Spell out the groups of observations and ratio parts alike: group_code, item_group_code and `_factor`."""
    if plan.area_groups:
        rows = rows.withColumn("group_code", F.explode("_area.group"))
    if plan.item_groups:
        if plan.distinct_rows:
            # The group itself does not matter here, so an item needs one row per factor only.
            rows = rows.withColumn("factor", F.explode_outer("_item"))
        else:
            rows = rows.withColumn("_member", F.explode("_item") if plan.item_key == "group" else F.explode_outer("_item"))
            rows = rows.withColumns({"item_group_code": F.col("_member.group"), "factor": F.col("_member.factor")})
        rows = rows.withColumn("_factor", factor_of(dims))
    if plan.distinct_rows:
        # Equal products count once, so they are formed before the copies go.
        tags = [c for c in ("_result", "_role") if c in rows.columns]
        rows = rows.withColumn(dims.value, product(dims.value)).select(*dims.columns, *tags).distinct()
    return rows.drop("_area", "_item", "_member", "factor")
