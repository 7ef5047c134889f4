"""One query per operator, over the stand-ins of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.standins import COMMON_YEAR, ITEM_DIMS, REQUESTED, YEARS, D, Standins
from tallycube.functions import strict_sum
from tallycube.operators import aggregate as agg
from tallycube.operators import coverage, crosswalk, groups, metadata, reconcile, reshape, residual, select, splice
from tallycube.operators.joins import group_total
from tallycube.plans.grouping import aggregate_session, rules_of
from tallycube.plans.ingest import ingest, ingest_folder, long_sections
from tallycube.plans.sync import SOURCE, sync, sync_slice
from tallycube.schema import ELEMENTS, MALE, URBAN, Dims
from tallycube.session import scratch_path
from tallycube.session import stored as settled
from tallycube.sources import (
    append_rules,
    literal_table,
    read_cube,
    read_release,
    read_table,
    read_typed,
    read_wide,
    write_cube,
    write_release,
    write_report,
    write_version,
)

Query = Callable[[Standins], DataFrame]
KEYS = [D.area, D.element, D.year]
CATALOG: dict[str, Query] = {}


def query(build: Query) -> Query:
    CATALOG[build.__name__] = build
    return build


@lru_cache(maxsize=4)
def standins(spark: SparkSession, folder: str) -> Standins:
    """Plans are shared between queries of a session; no data is kept."""
    return Standins(spark, folder)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return reshape.to_edge(CATALOG[name](standins(spark, folder)))


# --- sources and sinks ---


@query
def src_wide_csv(s: Standins) -> DataFrame:
    """A wide table of each element, written as CSV and read again."""
    s = s.settled()

    def read_again(element: str) -> DataFrame:
        path, wide = scratch_path(s.spark, "wide"), s.wide(element, "Estimates")
        write_report(wide, path)
        return read_wide(s.spark, path, wide.schema).withColumn(D.element, F.lit(element))

    return reduce(DataFrame.unionByName, map(read_again, ELEMENTS))


@query
def sink_roundtrip(s: Standins) -> DataFrame:
    """Cube, report and rule table written and read again; one year is replaced, one table appended to."""
    base = scratch_path(s.spark, "sink")
    write_cube(s.leaf, f"{base}/cube")
    doubled = s.leaf.filter(F.col(D.year) == COMMON_YEAR).withColumn(D.value, (F.col(D.value) * 2).cast("decimal(28,6)"))
    write_cube(doubled, f"{base}/cube")
    append_rules(s.conversion, f"{base}/rules")
    append_rules(s.conversion, f"{base}/rules")
    write_report(s.area_codes, f"{base}/report")
    cube = read_cube(s.spark, f"{base}/cube")
    rows = cube.groupBy(D.year, D.element).agg(F.count(F.lit(1)).alias("n"), F.sum(D.value).alias("total"))
    others = {"rules": read_table(s.spark, f"{base}/rules"), "report": read_wide(s.spark, f"{base}/report")}
    for name, table in others.items():
        count = table.agg(F.count(F.lit(1)).alias("n")).withColumns({D.element: F.lit(name), D.year: F.lit(0)})
        rows = rows.unionByName(count, allowMissingColumns=True)
    return rows


@query
def src_typed_csv(s: Standins) -> DataFrame:
    """Columns picked by name and typed, from a file with others and in another order; cells that do not fit are null."""
    path = scratch_path(s.spark, "typed")
    key = F.col("k")
    write_report(s.customers.select("name", F.when(key % 10 == 3, "n/a").otherwise(key.cast("string")).alias("Key"), F.col("area").alias("Code"), "nk"), path)
    return read_typed(s.spark, path, {"Code": "string", "Key": "double"})


@query
def release_roundtrip(s: Standins) -> DataFrame:
    """Cube and metadata written together, one year of both replaced; a version that was never published stays unseen."""
    base = scratch_path(s.spark, "release")
    texts = lambda rows, text: rows.select(*KEYS, F.lit(text).alias("Metadata_Value"))
    write_release(s.leaf, texts(s.leaf, "first"), base)
    year = s.leaf.filter(F.col(D.year) == COMMON_YEAR)
    doubled = year.withColumn(D.value, (F.col(D.value) * 2).cast("decimal(28,6)"))
    write_release(doubled, texts(year.filter(F.col(D.element) == "511"), "second"), base)
    write_version(doubled, texts(year, "torn"), base)
    cube, metadata = read_release(s.spark, base)
    totals = cube.groupBy(D.year).agg(F.count(F.lit(1)).alias("n"), F.sum(D.value).alias("total"))
    told = metadata.groupBy(D.year, F.col("Metadata_Value").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return totals.withColumn("part", F.lit("cube")).unionByName(told, allowMissingColumns=True)


@query
def cube_slice(s: Standins) -> DataFrame:
    countries = select.codes_of(s.area_codes, types=["country"])
    return select.slice_cube(s.leaf, areas=countries, elements=["511", "561"], years=range(1997, 2000))


@query
def codelist_filter(s: Standins) -> DataFrame:
    return select.codes_of(s.area_codes, types=["country"], selectable=True, current=True)


# --- ingest ---


@query
def ingest_unpivot(s: Standins) -> DataFrame:
    return ingest(s.sections, s.area_codes, COMMON_YEAR, first_year=int(YEARS[0])).cube


@query
def ingest_from_folder(s: Standins) -> DataFrame:
    """The same cube from ten tables with unlike headers, in one scan."""
    s = s.settled()
    base = scratch_path(s.spark, "folder")
    names = {"total": "both sexes", "male": "male", "female": "female", "urban": "urban", "rural": "rural"}
    odd = F.substring("Country code", 2, 20).cast("bigint") % 2 == 1
    for role, sections in s.sections.items():
        for section, wide in sections.items():
            if "medium" in sections:
                write_report(wide, f"{base}/{names[role]}_{section}")
                continue
            # A part of the table begins with a byte order mark, the other has further columns, and the years the other way round but for the last one.
            years = [*reversed(YEARS[:-1]), YEARS[-1]]
            write_report(wide.filter(~odd).withColumnRenamed("Country code", "\ufeffCountry code"), f"{base}/{names[role]}_{section}_1")
            write_report(wide.filter(odd).select(F.lit("x").alias("Index"), "Country code", F.lit("a,b").alias("Notes"), *years), f"{base}/{names[role]}_{section}_2")
    return ingest_folder(s.spark, base, s.area_codes, COMMON_YEAR, first_year=int(YEARS[0])).cube


@query
def ingest_metadata(s: Standins) -> DataFrame:
    return ingest(s.sections, s.area_codes, COMMON_YEAR, "WPP2019", "WUP2018", first_year=int(YEARS[0])).metadata()


@query
def splice_estimate_projection(s: Standins) -> DataFrame:
    return splice.splice(*long_sections(s.sections, COMMON_YEAR, int(YEARS[0])), COMMON_YEAR)


@query
def overlap_check(s: Standins) -> DataFrame:
    estimates, medium = long_sections(s.sections, COMMON_YEAR, int(YEARS[0]))
    sexes = F.col(D.element).isin("511", "512", "513")
    return splice.overlap_check(estimates.filter(sexes), medium, COMMON_YEAR)


@query
def ingest_overlaps(s: Standins) -> DataFrame:
    """Differences in the common year as an ingest tells them: roles without projections have none."""
    return ingest(s.sections, s.area_codes, COMMON_YEAR, first_year=int(YEARS[0])).overlaps


@query
def country_only(s: Standins) -> DataFrame:
    return select.country_only(s.leaf, s.area_codes)


@query
def unknown_codes(s: Standins) -> DataFrame:
    return select.unknown_codes(s.leaf, s.area_codes)


# --- reshape and scalar clean-up ---


@query
def pivot_elements(s: Standins) -> DataFrame:
    return reshape.pivot_elements(s.leaf, [D.area, D.year], ["511", "512", "513", "551", "561"])


@query
def fill_missing_flag(s: Standins) -> DataFrame:
    return reshape.fill_missing(s.leaf)


@query
def alias_area(s: Standins) -> DataFrame:
    return reshape.alias_area(s.leaf, {"C7": ["C1248", "X7"], "C10": ["X10"]})


@query
def recode_codes(s: Standins) -> DataFrame:
    renamed = s.customers.filter("k % 9 = 0")
    mapping = renamed.select(F.col("area").alias("old"), F.concat(F.lit("D"), F.col("k").cast("string")).alias("new"))
    return reshape.recode(s.leaf, D.area, mapping)


@query
def recode_dropping(s: Standins) -> DataFrame:
    """Codes mapped, and rows without a mapping dropped."""
    renamed = s.customers.filter("k % 9 = 0")
    mapping = renamed.select(F.col("area").alias("old"), F.concat(F.lit("D"), F.col("k").cast("string")).alias("new"))
    return reshape.recode(s.leaf, D.area, mapping, keep_unmapped=False)


@query
def cube_difference(s: Standins) -> DataFrame:
    """The leaf cube against another office's, all years and columns."""
    return reconcile.cube_difference(s.leaf, s.second, [*KEYS, D.value])


@query
def totals_by_validity(s: Standins) -> DataFrame:
    with_alias = reshape.alias_area(s.leaf, {"C7": ["C1248x"]})
    return reconcile.totals_by_validity(with_alias.filter(F.col(D.element) == "511"), s.validity, ["C1248x"])


@query
def src_below_preamble(s: Standins) -> DataFrame:
    """Files whose header comes after two lines of notes."""
    path = scratch_path(s.spark, "notes")
    lines = s.customers.select(F.floor(F.col("k") / 1000).alias("part"), F.concat_ws(",", "area", "nk").alias("line"))
    body = F.array_join(F.array_sort(F.collect_list("line")), "\n")  # a thousand customers at most
    tables = lines.groupBy("part").agg(F.concat(F.lit("Some notes\nand more\nCountry code,nation\n"), body).alias("value"))
    tables.write.partitionBy("part").text(path)
    return read_wide(s.spark, path, start_row=3)


@query
def src_quoted_preamble(s: Standins) -> DataFrame:
    """Below a preamble, records with quoted line breaks, commas and quotes."""
    path = scratch_path(s.spark, "quoted")
    name = F.concat(F.lit('"'), F.replace("name", F.lit("#"), F.lit('\n""')), F.lit(', x"'))
    lines = s.customers.select(F.floor(F.col("k") / 1000).alias("part"), F.concat_ws(",", name, "area").alias("line"))
    body = F.array_join(F.array_sort(F.collect_list("line")), "\n")  # a thousand customers at most
    tables = lines.groupBy("part").agg(F.concat(F.lit('An odd " note\nname,Country code\n'), body).alias("value"))
    tables.write.partitionBy("part").text(path)
    return read_wide(s.spark, path, start_row=2)


def _labelled(s: Standins) -> DataFrame:
    names = [("511", "Total"), ("512", "Male"), ("513", "Female"), ("561", "Urban")]
    elements = literal_table(s.spark, names, "code string, description string")
    return reshape.add_labels(s.leaf, {D.area: s.area_codes, D.element: elements})


@query
def label_join(s: Standins) -> DataFrame:
    return _labelled(s)


@query
def label_list(s: Standins) -> DataFrame:
    label = f"{D.area}_description"
    return _labelled(s).select(label).distinct().orderBy(label)


@query
def unlabelled_codes(s: Standins) -> DataFrame:
    return reshape.unlabelled(_labelled(s), D.area)


@query
def head_rows(s: Standins) -> DataFrame:
    return select.head_rows(s.leaf, 10)


@query
def year_bounds(s: Standins) -> DataFrame:
    return select.year_bounds(s.leaf)


@query
def valid_area_years(s: Standins) -> DataFrame:
    return select.valid_area_years(s.leaf, s.validity)


@query
def validity_disjoint(s: Standins) -> DataFrame:
    spans = select.disjoint_validity(s.validity)
    return spans.withColumns({c: F.col(c).cast("string") for c in ("start_year", "end_year")})


@query
def sum_strict(s: Standins) -> DataFrame:
    """Parent totals written back to each member row."""
    members = residual.parents(s.hierarchy).select("parent", F.col("member").alias(D.area))
    rows = s.leaf.join(members, D.area).select("parent", *KEYS, D.value)
    return group_total(rows, ["parent", D.element, D.year], parent_total=strict_sum(D.value))


# --- crosswalk and coverage ---


def _crosswalk(s: Standins) -> DataFrame:
    return crosswalk.crosswalk(s.source_codes, s.target_codes, s.approved)


def _reporting(s: Standins) -> DataFrame:
    return select.compliant_only(s.source, _crosswalk(s))


@query
def crosswalk_compliance(s: Standins) -> DataFrame:
    return _crosswalk(s)


@query
def crosswalk_exceptions(s: Standins) -> DataFrame:
    return crosswalk.exceptions(_crosswalk(s))


@query
def crosswalk_matched_elsewhere(s: Standins) -> DataFrame:
    return crosswalk.matched_elsewhere(_crosswalk(s))


@query
def compliant_filter(s: Standins) -> DataFrame:
    return _reporting(s)


@query
def coverage_missing(s: Standins) -> DataFrame:
    return coverage.missing_areas(s.leaf)


@query
def coverage_missing_cells(s: Standins) -> DataFrame:
    return coverage.missing_cells(s.leaf)


@query
def one_sided_sex(s: Standins) -> DataFrame:
    return coverage.one_sided(s.leaf)


@query
def coverage_report(s: Standins) -> DataFrame:
    return coverage.coverage_report(s.leaf)


@query
def hier_mixed_level(s: Standins) -> DataFrame:
    wanted = residual.gap_parents(s.leaf, s.hierarchy, (MALE, URBAN))
    return residual.members_of(s.hierarchy, wanted)


@query
def hier_descendants(s: Standins) -> DataFrame:
    """Members of all level-3 codes, those below a level-4 area included."""
    level3 = s.hierarchy.select(F.col("code_l3").alias("parent"), F.lit("512").alias("gap")).distinct()
    return residual.members_of(s.hierarchy, level3, include_descendants=True).drop("gap")


@query
def missing_residual_code(s: Standins) -> DataFrame:
    known = s.conversion.select(F.regexp_replace("residual_code", r"\.01$", "").alias("parent"))
    wanted = residual.gap_parents(s.leaf, s.hierarchy, (MALE, URBAN)).select("parent").distinct()
    return residual.missing_residual_codes(wanted, known)


@query
def country_year_coverage(s: Standins) -> DataFrame:
    return coverage.country_year_coverage(s.leaf, s.area_codes, COMMON_YEAR)


@query
def missing_countries(s: Standins) -> DataFrame:
    rows = coverage.missing_countries(s.leaf, s.area_codes, s.validity, COMMON_YEAR)
    return rows.withColumns({c: F.col(c).cast("string") for c in ("start_year", "end_year")})


# --- residual areas, aliases, metadata ---


@query
def residual_areas(s: Standins) -> DataFrame:
    """Residuals of both sexes and of urban and rural population, over compliant areas."""
    return residual.residual_areas(s.source, _reporting(s), s.hierarchy, s.conversion, s.flag_weights)


def _sync(s: Standins):
    return sync(
        s.source, _crosswalk(s), s.hierarchy, s.conversion, 1999, 1997, s.flag_weights, aliases={"C7": ["C1248x"]}
    )


@query
def operational_cube(s: Standins) -> DataFrame:
    return _sync(s).cube


@query
def operational_slice(s: Standins) -> DataFrame:
    """The operational cube from a stored source with areas and years that its code lists do not name."""
    source = settled(s.source, "whole-source")
    others = source.withColumn(D.area, F.concat(F.lit("Q"), D.area))
    none = source.filter(F.col(D.year) == int(YEARS[0])).withColumn(D.year, F.lit(0))
    base = scratch_path(s.spark, "source")
    write_cube(source.unionByName(others).unionByName(none).withColumnRenamed(D.area, SOURCE.area), f"{base}/cube")
    append_rules(source.select(F.col(D.area).alias("code")).distinct(), f"{base}/areas")
    stored, areas = read_cube(s.spark, f"{base}/cube"), read_table(s.spark, f"{base}/areas")
    years = stored.select(F.col(D.year).cast("string").alias("code")).distinct()
    return sync_slice(
        stored, areas, years, _crosswalk(s), s.hierarchy, s.conversion, 1999, 1997, s.flag_weights, aliases={"C7": ["C1248x"]}
    ).cube


@query
def metadata_build(s: Standins) -> DataFrame:
    return _sync(s).metadata()


@query
def identity_check(s: Standins) -> DataFrame:
    """Over all reporting areas: the sexes of the members and the residual add up to the total."""
    sexes = residual.RULES[:1]
    residuals = residual.residual_areas(s.source, s.leaf, s.hierarchy, s.conversion, s.flag_weights, sexes)
    members = residual.members_of(s.hierarchy, residual.gap_parents(s.leaf, s.hierarchy)).drop("gap")
    return reconcile.identity_check(s.leaf, members, residuals)


# --- group aggregation ---


def _rules(s: Standins) -> agg.Rules:
    return agg.Rules(
        area_members=s.area_groups,
        item_members=s.item_groups,
        validity=s.validity,
        calculated=s.calculated,
        flag_weights=s.flag_weights,
        area_rules=s.area_rules,
        item_rules=s.item_rules,
        excluded=s.excluded,
    )


def _aggregate(mode: str) -> Query:
    def build(s: Standins) -> DataFrame:
        return agg.aggregate(s.items, mode, _rules(s), REQUESTED, ITEM_DIMS)

    return build


for _mode in agg.MODES:
    CATALOG[f"agg_{_mode}"] = _aggregate(_mode)


@query
def agg_population_area(s: Standins) -> DataFrame:
    """Area groups of the cube without items."""
    rules = agg.Rules(area_members=s.area_groups, validity=s.validity, flag_weights=s.flag_weights)
    return agg.aggregate(s.leaf, "area", rules, ELEMENTS)


@query
def agg_population_world(s: Standins) -> DataFrame:
    rules = agg.Rules(area_members=s.area_groups, flag_weights=s.flag_weights)
    return agg.aggregate(s.leaf, "adhoc_area", rules, ELEMENTS)


@query
def agg_session_item(s: Standins) -> DataFrame:
    """Item groups of the session's areas and years, with all items."""
    return aggregate_session(
        s.items, "item", _rules(s), s.area_codes, s.session_areas, REQUESTED, range(1996, 2000), items=["SMALL"], dims=ITEM_DIMS
    )


@query
def agg_session_area(s: Standins) -> DataFrame:
    """Area groups over all countries, for the session's items and years."""
    return aggregate_session(
        s.items, "area", _rules(s), s.area_codes, s.session_areas, ["5622"], range(1996, 2000), items=["SMALL", "PROMO"], dims=ITEM_DIMS
    )


@query
def agg_stored_rules(s: Standins) -> DataFrame:
    """Area groups with rule tables as they are stored, by domain, and with dimensions found by their names."""
    base = scratch_path(s.spark, "rules")
    domain = F.lit("Production").alias("master_domain")

    def kinds(of, **tables: DataFrame) -> DataFrame:
        """Rows of areas and items, and those of another domain, which must not be read."""
        own = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [of(t).withColumn("var_type", F.lit(k)) for k, t in tables.items()])
        return own.select("*", domain).unionByName(own.withColumns({"master_domain": F.lit("Trade"), "var_code_sws": F.lit("x")}))

    grouped = kinds(lambda t: t.withColumnsRenamed({"group_code": "var_group_code_sws", "member_code": "var_code_sws"}), area=s.area_groups, item=s.item_groups)
    listed = kinds(lambda t: t.withColumnsRenamed({"code": "var_code_sws", "flag": "domain_var_diss_flag_agg_int"}), area=s.area_rules, item=s.item_rules)
    tables = {
        "aggregate_groups": grouped,
        "aggregate_type": listed,
        "area_years": s.validity,
        "calculated_elements": s.calculated.withColumn("remark", F.lit("not read")),
        "flag_weight_table": s.flag_weights.withColumnsRenamed({"flag": "flag_observation_status", "weight": "flag_observation_weights"}),
        "elements_to_not_aggregate": s.excluded,
    }
    for name, table in tables.items():
        append_rules(table, f"{base}/{name}")
    dims = Dims.discover(s.items.columns)
    rules = rules_of(lambda name: read_table(s.spark, f"{base}/{name}"), "agriculture", "production", has_item=dims.item is not None)
    return aggregate_session(
        s.items, "area", rules, s.area_codes, s.session_areas, ["5622"], range(1996, 2000), items=["SMALL", "PROMO"], dims=dims
    )


@query
def agg_ratio_element(s: Standins) -> DataFrame:
    ratios = groups.usable_ratios(s.calculated)
    by = [ITEM_DIMS.area, ITEM_DIMS.year]
    return agg.aggregate_ratio(s.items, by, ratios, ITEM_DIMS).select(*by, ITEM_DIMS.element, ITEM_DIMS.value)


@query
def agg_flag(s: Standins) -> DataFrame:
    return agg.aggregate_flags(s.items, [ITEM_DIMS.area, ITEM_DIMS.year], s.flag_weights, ITEM_DIMS)


@query
def expand_elements(s: Standins) -> DataFrame:
    return groups.expand_elements(s.requested, s.calculated)


@query
def group_members_clean(s: Standins) -> DataFrame:
    return groups.clean_members(s.area_groups)


@query
def duplicate_members(s: Standins) -> DataFrame:
    return groups.later_copies(s.area_groups, ["group_code", "member_code"])


@query
def duplicate_member_rows(s: Standins) -> DataFrame:
    """All membership rows, the later copies of a pair marked."""
    return groups.mark_later(s.area_groups, ["group_code", "member_code"])


@query
def first_by_key(s: Standins) -> DataFrame:
    """The earliest observation of each area and element."""
    return groups.first_of_key(s.leaf, [D.area, D.element], [D.year, D.value])


@query
def apply_factor(s: Standins) -> DataFrame:
    return groups.apply_factor(s.items, groups.item_factors(s.item_groups), ITEM_DIMS)


@query
def drop_existing_aggregates(s: Standins) -> DataFrame:
    pairs = s.area_groups.dropna("any")
    return groups.drop_existing_aggregates(s.items, pairs, s.item_groups, ITEM_DIMS)


@query
def dissemination_filter(s: Standins) -> DataFrame:
    listed = groups.disseminated(s.area_rules).withColumn("list", F.lit("any"))
    return listed.unionByName(groups.disseminated(s.area_rules, full_only=True).withColumn("list", F.lit("full")))


@query
def exclude_elements(s: Standins) -> DataFrame:
    return groups.exclude_elements(s.items, s.excluded, ITEM_DIMS)


@query
def excluded_elements(s: Standins) -> DataFrame:
    return groups.excluded_elements(s.items, s.excluded, ITEM_DIMS)


@query
def group_list_compare(s: Standins) -> DataFrame:
    """Nation groups against a list in which some areas moved."""
    member = F.col("area").alias("member_code")
    left = s.customers.select(F.expr("concat('G', nk)").alias("group_code"), member)
    right = s.customers.select(F.expr("concat('G', if(k % 71 = 0, nk + 1, nk))").alias("group_code"), member)
    return crosswalk.compare_memberships(left, right)


# --- reconciliation ---


@query
def recon_status(s: Standins) -> DataFrame:
    return reconcile.reconcile(s.second, s.leaf, KEYS)


@query
def recon_match_rate(s: Standins) -> DataFrame:
    return reconcile.match_rate(reconcile.reconcile(s.second, s.leaf, KEYS))


@query
def recon_relative_change(s: Standins) -> DataFrame:
    return reconcile.large_changes(reconcile.compare(s.leaf, s.second, KEYS)).drop("percent")


@query
def recon_percent_variation(s: Standins) -> DataFrame:
    totals = [df.filter(F.col(D.element) == "511") for df in (s.leaf, s.second)]
    return reconcile.compare(*totals, [D.area, D.year]).drop("change")


@query
def recon_threshold(s: Standins) -> DataFrame:
    """Published regions against regions computed from groups, matched by label."""
    region = s.table("region").select(F.col("r_regionkey").alias("rk"), F.col("r_name").alias("label"))
    placed = s.full_cube.filter("element = '511'").join(s.placed.select("k", "rk"), "k")
    shift = F.expr("case when rk = 1 then 0.05 when rk = 2 then 1 when rk = 3 then -1 else 0 end").cast("decimal(28,6)")
    published = (
        placed.groupBy("rk", "yr")
        .agg(F.sum("v").alias("v"))
        .join(region, "rk")
        .select(
            F.initcap("label").alias("label"),
            F.col("yr").alias(D.year),
            (F.col("v") + shift).cast("decimal(28,6)").alias(D.value),
        )
    )
    spelling = region.select(F.initcap("label").alias("old"), F.col("label").alias("new"))
    published = reshape.recode(published, "label", spelling)
    totals = s.full_cube.filter("element = '511'").select(F.concat(F.lit("C"), "k").alias(D.area), "yr", "v")
    members = groups.clean_members(s.area_groups).withColumnRenamed("member_code", D.area)
    computed = totals.join(members, D.area).groupBy("group_code", "yr").agg(F.sum("v").alias("v"))
    # One region is missing from the code list and added by hand.
    codes = region.filter("rk <> 4").select(F.concat(F.lit("GR"), "rk").alias("code"), "label")
    codes = codes.unionByName(literal_table(s.spark, [("GR4", "MIDDLE EAST")], "code string, label string"))
    computed = computed.join(codes, computed["group_code"] == codes["code"]).select(
        "label", F.col("yr").alias(D.year), F.col("v").cast("decimal(28,6)").alias(D.value)
    )
    return reconcile.area_totals(published, computed, ["label", D.year])


@query
def recon_original(s: Standins) -> DataFrame:
    key = F.substring(D.area, 2, 20).cast("bigint")
    totals = s.leaf.filter(F.col(D.element) == "511")
    shift = F.when(key % 8 == 0, F.lit("0.001")).when(key % 5 == 0, F.lit("0.0004")).otherwise("0").cast("decimal(28,6)")
    original = totals.filter(key % 15 != 1).withColumn(D.value, (F.col(D.value) + shift).cast("decimal(28,6)"))
    return reconcile.original_check(totals.filter(key % 14 != 1), original, [D.area, D.year])


@query
def world_total_no_double(s: Standins) -> DataFrame:
    with_alias = reshape.alias_area(s.leaf, {"C7": ["C1248x"]})
    year = with_alias.filter((F.col(D.year) == 2000) & (F.col(D.element) == "511"))
    return reconcile.control_total(select.without_areas(year, ["C1248x"]))


@query
def recon_paired_areas(s: Standins) -> DataFrame:
    """Differences of each two areas next to each other, some within given years."""
    totals = [df.filter(F.col(D.element) == "511") for df in (s.leaf, s.second)]
    pairs = s.customers.filter("k % 2 = 0").select(
        F.col("area").alias("left"),
        F.expr("concat('C', k + 1)").alias("right"),
        F.expr("if(k % 4 = 0, 1996, null)").alias("from_year"),
        F.expr("if(k % 6 = 0, 1999, null)").alias("to_year"),
    )
    return reconcile.paired_differences(reconcile.compare(*totals, [D.area, D.year]), pairs, D.area)
