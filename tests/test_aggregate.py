import pytest
from pyspark.errors import SparkRuntimeException

from helpers import cube, item_cube, rows, table

from tallycube.operators import aggregate as agg
from tallycube.operators import groups
from tallycube.plans.grouping import aggregate_session, group_domain, rules_of
from tallycube.schema import Dims

DIMS = Dims(item="measuredItemCPC")
AREA, ELEMENT, ITEM, VALUE = DIMS.area, DIMS.element, DIMS.item, DIMS.value
MEMBERS = "group_code string, member_code string"
FACTORS = "group_code string, member_code string, factor double"


def weights(spark):
    return table(spark, "flag string, weight double", ("X", 1.0), ("E", 0.5), (None, 1.0))


def ratios(spark):
    return table(
        spark,
        "result_var_code string, num_var_code string, den_var_code string, mult double",
        ("R", "N", "D", 10.0),
        ("664", "N", "D", 1.0),
        ("Q", "N", "5319", 1.0),
    )


def rules(spark, **more):
    return agg.Rules(
        area_members=table(spark, MEMBERS, ("G", "a"), ("G", "b"), ("953", "a"), ("953", "b"), ("953", "G")),
        item_members=table(spark, FACTORS, ("I", "i", 0.5), ("I", "j", None), ("J", "i", 2.0)),
        flag_weights=weights(spark),
        calculated=ratios(spark),
        **more,
    )


def test_membership_is_cleaned(spark):
    pairs = table(spark, MEMBERS, ("W", "a"), ("W", "a"), ("W", "G"), ("G", "b"), ("G", None), (None, "c"))
    assert rows(groups.clean_members(pairs), "group_code", "member_code") == [("G", "b"), ("W", "a")]
    assert rows(groups.later_copies(pairs, ["group_code", "member_code"])) == [("W", "a", 1)]


def test_first_row_of_a_key(spark):
    df = table(spark, "k string, y int, v string", ("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z"))
    assert rows(groups.first_of_key(df, ["k"], ["y"])) == [("a", 1, "y"), ("b", 3, "z")]


def test_factors(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 3), ("a", "5922", "i", 1950, 3), ("a", "N", "j", 1950, 3), ("a", "N", "k", 1950, 3))
    factors = groups.item_factors(table(spark, FACTORS, ("I", "i", 0.5), ("I", "i", 0.25), ("I", "j", None)))
    got = rows(groups.apply_factor(df, factors, DIMS), ELEMENT, ITEM, VALUE, "item_group_code")
    assert got == [("5922", "i", 3.0, "I"), ("N", "i", 1.5, "I"), ("N", "j", 3.0, "I"), ("N", "k", 3.0, None)]


def test_factors_keep_their_digits(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 3_000_000), ("a", "N", "j", 1950, 3_000_000))
    factors = groups.item_factors(table(spark, FACTORS, ("I", "i", 0.33333333), ("I", "j", 0.00004)))
    assert rows(groups.apply_factor(df, factors, DIMS), ITEM, VALUE) == [("i", 999999.99), ("j", 120.0)]
    with pytest.raises(SparkRuntimeException):
        groups.item_factors(table(spark, FACTORS, ("I", "i", 1e-19))).collect()
    with pytest.raises(SparkRuntimeException):
        groups.item_factors(table(spark, FACTORS, ("I", "i", 123456.0))).collect()


def test_a_third_as_a_double_is_a_factor(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 3_000_000), ("a", "N", "i", 1951, 0.5))
    factors = groups.item_factors(table(spark, FACTORS, ("I", "i", 1 / 3)))
    assert rows(groups.apply_factor(df, factors, DIMS), VALUE) == [(0.1666666667,), (999999.9999999999,)]


def test_a_flag_listed_as_null_and_empty_counts_once(spark):
    more = weights(spark).unionByName(table(spark, "flag string, weight double", ("", 3.0), ("X", 1.0)))
    df = item_cube(spark, ("a", "N", "i", 1950, 7, None))
    out = agg.group_rows(df, [AREA], DIMS, flag_weights=more)
    assert rows(out, VALUE) == [(7.0,)]


def test_two_definitions_of_a_ratio_are_an_error(spark):
    twice = ratios(spark).unionByName(table(spark, ratios(spark).schema.simpleString()[7:-1].replace(":", " "), ("R", "N", "E", 1.0)))
    with pytest.raises(SparkRuntimeException):
        groups.usable_ratios(twice).collect()
    assert rows(groups.usable_ratios(ratios(spark).union(ratios(spark)))) == [("R", "N", "D", 10.0)]


def test_item_groups_are_dropped_without_area_groups(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 3), ("a", "N", "I", 1950, 3), ("a", "N", "AH01", 1950, 3))
    plain = agg.Rules(item_members=table(spark, FACTORS, ("I", "i", 1.0)))
    assert rows(agg.clean_rows(df, plain, DIMS), ITEM) == [("i",)]


def test_dissemination_lists(spark):
    df = table(
        spark,
        "domain_name string, code string, flag int",
        ("P", "a", 1),
        ("P", "b", 0),
        ("P", "c", None),
        ("P", "d", 99),
        ("Trade Flow", "e", 99),
        (None, "f", 1),
        ("P", None, 1),
    )
    assert rows(groups.disseminated(df)) == [("a",), ("d",), ("f",)]
    assert rows(groups.disseminated(df, full_only=True)) == [("d",)]


def test_elements_expand_to_ratio_parts(spark):
    requested = table(spark, "code string", ("R",), ("X",), ("664",), ("Q",))
    assert rows(groups.expand_elements(requested, ratios(spark))) == [("664",), ("D",), ("N",), ("Q",), ("R",), ("X",)]


def test_area_sum_drops_incomplete_rows_and_item_sum_does_not(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, None), ("b", "N", "j", 1950, 2), ("b", "N", "i", 1951, None))
    by_area = agg.aggregate(df, "area", rules(spark), ["N"], DIMS)
    assert rows(by_area, AREA, ITEM, "timePointYears", VALUE) == [("953", "j", 1950, 2.0), ("G", "j", 1950, 2.0)]
    by_item = agg.aggregate(df, "item", rules(spark), ["N"], DIMS)
    assert rows(by_item, AREA, ITEM, "timePointYears", VALUE) == [
        ("a", "I", 1950, 0.0),
        ("a", "J", 1950, 0.0),
        ("b", "I", 1950, 2.0),
        ("b", "I", 1951, 0.0),
        ("b", "J", 1951, 0.0),
    ]


def test_existing_aggregates_do_not_count(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 1), ("G", "N", "i", 1950, 9), ("a", "N", "I", 1950, 9), ("a", "N", "AH01", 1950, 9))
    got = agg.aggregate(df, "adhoc_area", rules(spark), ["N"], DIMS)
    assert rows(got, AREA, ITEM, VALUE, "flagMethod") == [("AH01", "i", 1.0, "x")]


def test_ratio_needs_both_parts_and_its_own_row(spark):
    df = item_cube(
        spark,
        ("a", "N", "i", 1950, 6),
        ("a", "D", "i", 1950, 2),
        ("a", "R", "i", 1950, 0),
        ("b", "N", "i", 1950, 100),
        ("a", "N", "j", 1950, 6),
        ("a", "D", "j", 1950, 3),
        ("a", "N", "k", 1950, 6),
        ("a", "D", "k", 1950, 0),
        ("a", "R", "k", 1950, 0),
    )
    got = agg.aggregate(df, "area", rules(spark), ["R"], DIMS)
    values = {(r[0], r[1], r[2]): r[3] for r in rows(got, AREA, ITEM, ELEMENT, VALUE)}
    assert values[("G", "i", "R")] == 30.0
    assert values[("G", "i", "N")] == 106.0
    assert ("G", "j", "R") not in values and ("G", "k", "R") not in values


def test_factors_apply_to_the_parts_of_a_ratio(spark):
    df = item_cube(
        spark,
        *[("a", e, "i", 1950, v) for e, v in (("N", 8), ("D", 2), ("R", 0))],
        *[("a", e, "j", 1950, v) for e, v in (("N", 6), ("D", 3), ("R", 0))],
    )
    got = agg.aggregate(df, "item", rules(spark), ["R"], DIMS)
    values = {r[0]: r[1] for r in rows(got.filter("measuredElement = 'R'"), ITEM, VALUE)}
    assert values["I"] == pytest.approx((8 * 0.5 + 6) / (2 * 0.5 + 3) * 10)
    assert values["J"] == pytest.approx(40.0)


def test_adhoc_item_counts_equal_products_once(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 4), ("a", "N", "k", 1950, 1))
    got = agg.aggregate(df, "adhoc_item", rules(spark), ["N"], DIMS)
    # Item i is in two groups with factors 0.5 and 2, item k in none.
    assert rows(got, AREA, ITEM, VALUE) == [("a", "AH01", 2.0 + 8.0 + 1.0)]
    same = agg.Rules(item_members=table(spark, FACTORS, ("I", "i", 1.0), ("J", "i", None)), flag_weights=weights(spark))
    assert rows(agg.aggregate(df, "adhoc_item", same, ["N"], DIMS), VALUE) == [(5.0,)]


def test_both_axes(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 4), ("b", "N", "j", 1950, 1))
    got = rows(agg.aggregate(df, "area_item", rules(spark), ["N"], DIMS), AREA, ITEM, VALUE)
    assert got == [("953", "I", 3.0), ("953", "J", 8.0), ("G", "I", 3.0), ("G", "J", 8.0)]
    world = rows(agg.aggregate(df, "adhoc_area_item", rules(spark), ["N"], DIMS), AREA, ITEM, VALUE)
    assert world == [("AH01", "AH01", 2.0 + 8.0 + 1.0)]


def test_lists_and_exclusions(spark):
    df = item_cube(spark, ("a", "N", "i", 1950, 4), ("b", "N", "i", 1950, 1), ("a", "Z", "i", 1950, 1))
    listed = table(spark, "domain_name string, code string, flag int", ("P", "a", 1))
    out = table(spark, "element_code string", ("Z",))
    got = agg.aggregate(df, "area", rules(spark, area_rules=listed, item_rules=listed.limit(0), excluded=out), ["N", "Z"], DIMS)
    assert rows(got, AREA, ELEMENT, VALUE) == [("953", "N", 4.0), ("G", "N", 4.0)]
    # No area is fully disseminated here, but the list itself is not empty.
    both = agg.aggregate(df, "area_item", rules(spark, area_rules=listed), ["N"], DIMS)
    assert rows(both) == []
    assert rows(groups.excluded_elements(df, out, DIMS)) == [("Z",)]


def test_flags(spark):
    df = item_cube(
        spark,
        ("a", "N", "i", 1950, 1, "X"),
        ("a", "N", "j", 1950, 1, "E"),
        ("b", "N", "i", 1950, 1, "X"),
        ("b", "N", "j", 1950, 1, None),
        ("c", "N", "i", 1950, 1, "?"),
        ("c", "N", "j", 1950, 1, "X"),
    )
    got = rows(agg.aggregate_flags(df, [AREA], weights(spark), DIMS), AREA, "flagObservationStatus")
    assert got == [("a", "E"), ("b", ""), ("c", "X")]
    most = rows(agg.aggregate_flags(df, [AREA], weights(spark), DIMS, weakest="max"), AREA, "flagObservationStatus")
    assert most == [("a", "X"), ("b", ""), ("c", "X")]


def test_without_items_only_area_modes(spark):
    df = cube(spark, ("a", "511", 1950, 1), ("b", "511", 1950, 2, None))
    only_area = agg.Rules(area_members=table(spark, MEMBERS, ("G", "a"), ("G", "b")), flag_weights=weights(spark))
    got = agg.aggregate(df, "area", only_area, ["511"])
    # The second row lacks a flag, so it is incomplete.
    assert rows(got) == [("G", "511", 1950, 1.0, "X", "x")]
    with pytest.raises(ValueError):
        agg.aggregate(df, "item", only_area, ["511"])


def test_single_flag_column(spark):
    df = table(
        spark,
        "geographicAreaM49 string, measuredElement string, timePointYears int, Value decimal(28,6), flagOffice string",
        ("a", "511", 1950, 1, "F"),
        ("b", "511", 1950, 2, "F"),
    )
    only_area = agg.Rules(area_members=table(spark, MEMBERS, ("G", "a"), ("G", "b")))
    got = agg.aggregate(df, "area", only_area, ["511"], Dims.discover(df.columns))
    assert rows(got) == [("G", "511", 1950, 3.0, "x")]


def test_rule_tables_of_a_domain(spark):
    groups_schema = (
        "var_type string, master_domain string, var_group_code string, var_group_code_new string, var_code_new string, factor double"
    )
    lists_schema = (
        "var_type string, master_domain string, domain_name string, var_code_new string, domain_var_diss_flag_agg_int int"
    )
    tables = {
        "aggregate_groups": table(
            spark,
            groups_schema,
            ("area", "suafbs", "old", "G", "a", None),
            ("area", "Food Balance", "old", "H", "a", None),
            ("item", "suafbs", "old", "I", "i", 0.5),
        ),
        "aggregate_type": table(spark, lists_schema, ("area", "Food Balance", "P", "a", 1), ("item", "Trade", "P", "i", 1)),
        "area_years": table(spark, "m49 string, start_year int, end_year int, note string", ("a", None, None, "")),
        "calculated_elements": ratios(spark),
        "flag_weight_table": table(
            spark, "flag_observation_status string, flag_observation_weights double", ("X", 1.0), (None, 1.0)
        ),
        "elements_to_not_aggregate": table(spark, "element_code string", ("Z",)),
    }
    found = rules_of(tables.__getitem__, "suafbs", "sua_balanced", has_item=True)
    df = item_cube(spark, ("a", "N", "i", 1950, 4), ("b", "N", "i", 1950, 4), ("a", "Z", "i", 1950, 4), ("a", "N", "i", 1960, 4))
    codes = table(spark, "code string, type string", ("a", "country"), ("b", "country"))
    got = aggregate_session(df, "area", found, codes, ["b"], ["N", "Z"], [1950], ["i"], dims=DIMS)
    assert rows(got, AREA, ELEMENT, VALUE) == [("G", "N", 4.0)]
    assert group_domain("suafbs", "other") == "Food Balance"
    with pytest.raises(ValueError):
        group_domain("unknown", "x")


def test_later_rows_are_marked(spark):
    df = table(spark, "g string, m string, v int", ("a", "x", 2), ("a", "x", 1), ("a", "x", 1), ("a", None, 5), ("a", None, 5), ("b", "x", 1))
    got = rows(groups.mark_later(df, ["g", "m"], ["v"]))
    assert got == sorted(
        [("a", "x", 1, False), ("a", "x", 1, True), ("a", "x", 2, True), ("a", None, 5, False), ("a", None, 5, True), ("b", "x", 1, False)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert rows(groups.mark_later(df, ["g", "m", "v"]), "later").count((True,)) == 2


def test_rules_meet_rows_once_and_without_lambdas(spark):
    """observations and ratio parts meet the rules together, and lambdas run on the rules, not on each row."""
    cube = spark.createDataFrame([("A", "5510", "S", 2000, 2.0, "X", "h"), ("A", "5312", "S", 2000, 4.0, "X", "h"), ("A", "5419", "S", 2000, 0.0, "X", "h")], ["geographicAreaM49", "measuredElement", "measuredItemCPC", "timePointYears", "Value", "flagObservationStatus", "flagMethod"])
    rules = agg.Rules(
        item_members=spark.createDataFrame([("G", "S", 0.5), ("H", "S", 0.5)], "group_code string, member_code string, factor double"),
        validity=spark.createDataFrame([("A", 1990, 1995), ("A", 1999, 2001)], "m49 string, start_year int, end_year int"),
        calculated=spark.createDataFrame([("5419", "5510", "5312", 10.0)], "result_var_code string, num_var_code string, den_var_code string, mult double"),
        flag_weights=spark.createDataFrame([("X", 1.0)], "flag string, weight double"),
    )
    out = agg.aggregate(cube, "adhoc_item", rules, ["5510", "5419"], Dims(item="measuredItemCPC"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "lambdafunction" in line and "Relation" not in line] == []
    assert sum("Relation [code#" in line and "parquet" in line for line in plan.splitlines()) == 2
    assert {(r.measuredElement, r.Value) for r in out.collect()} == {("5510", 1.0), ("5312", 2.0), ("5419", 5.0)}
