"""Group aggregation of a stored dataset: rule tables of its domain, slice of the session, aggregates."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycube.operators.aggregate import MODES, Rules, aggregate
from tallycube.operators.select import Keys, session_keys, slice_cube
from tallycube.schema import POPULATION, Dims
from tallycube.sources.tables import read_rules

# Names of the rule tables' domains, by domain of the dataset. Food balances differ in
# their groups for three datasets.
GROUP_DOMAINS = {
    "trade": "Trade",
    "macro_stats": "Macro-Statistics",
    "agriculture": "Production",
    "suafbs": "Food Balance",
    "population": "Population",
}
BALANCE_DATASETS = ("fbs_standardized", "sua_unbalanced", "sua_balanced")
BALANCE_DOMAIN = "suafbs"


def group_domain(domain: str, dataset: str, domains: Mapping[str, str] = GROUP_DOMAINS) -> str:
    """Rule domain of the group memberships; a domain without one is an error, as it would select no members."""
    if domain not in domains:
        raise ValueError(f"no rule domain for {domain!r}, known are {sorted(domains)}")
    if domain == "suafbs" and dataset in BALANCE_DATASETS:
        return BALANCE_DOMAIN
    return domains[domain]


def rules_of(
    read: Callable[[str], DataFrame], domain: str, dataset: str, has_item: bool, domains: Mapping[str, str] = GROUP_DOMAINS
) -> Rules:
    """Rule tables of a domain, each read with its filter and columns only.

    `read` opens a rule table by name, e.g. `lambda n: spark.read.parquet(f"{folder}/{n}")`.
    """
    groups, lists = read("aggregate_groups"), read("aggregate_type")
    member_domain, list_domain = group_domain(domain, dataset, domains), domains[domain]
    weights = read("flag_weight_table").select(
        F.col("flag_observation_status").alias("flag"), F.col("flag_observation_weights").alias("weight")
    )

    def members(kind: str) -> DataFrame:
        rows = read_rules(groups, var_type=kind, master_domain=member_domain)
        return rows.select(
            F.col(_column(rows, "var_group_code")).alias("group_code"),
            F.col(_column(rows, "var_code")).alias("member_code"),
            "factor",
        )

    def listed(kind: str) -> DataFrame:
        rows = read_rules(lists, var_type=kind, master_domain=list_domain)
        return rows.select(
            "domain_name", F.col(_column(rows, "var_code")).alias("code"), F.col("domain_var_diss_flag_agg_int").alias("flag")
        )

    return Rules(
        area_members=members("area").drop("factor"),
        item_members=members("item") if has_item else None,
        validity=read("area_years").select("m49", "start_year", "end_year"),
        calculated=read("calculated_elements").select("result_var_code", "num_var_code", "den_var_code", "mult"),
        flag_weights=weights,
        area_rules=listed("area"),
        item_rules=listed("item"),
        excluded=read("elements_to_not_aggregate").select("element_code"),
    )


def aggregate_session(
    cube: DataFrame,
    mode: str,
    rules: Rules,
    area_codes: DataFrame,
    areas: Keys,
    elements: Sequence[str],
    years: Keys,
    items: Keys = None,
    item_codes: DataFrame | None = None,
    dims: Dims = POPULATION,
) -> DataFrame:
    """Aggregates of a session's slice; modes on groups replace a session axis by all of its codes."""
    if MODES[mode].needs_item and not dims.item:
        raise ValueError(f"mode {mode!r} needs an item dimension")
    area_keys, item_keys = session_keys(mode, areas, items, area_codes, item_codes)
    rows = slice_cube(cube, areas=area_keys, years=years, items=item_keys if dims.item else None, dims=dims)
    return aggregate(rows, mode, rules, elements, dims)


def _column(table: DataFrame, stem: str) -> str:
    """The code column of a rule table; the version with a suffix is the one in use, if there is one."""
    found = [c for c in table.columns if re.fullmatch(rf"{stem}(_[a-z0-9]+)?", c)]
    return max(found, key=len)
