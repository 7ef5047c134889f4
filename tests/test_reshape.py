from decimal import Decimal

from helpers import cube, rows, table

from pyspark.sql import functions as F
from tallycube.functions import strict_sum
from tallycube.operators import reshape
from tallycube.operators.joins import drop_listed, full_join, group_total, keep_listed_if_any
from tallycube.operators.splice import overlap_check, splice

AREA, VALUE = "geographicAreaM49", "Value"


def test_melt_keeps_empty_cells(spark):
    wide = table(spark, "a string, `1950` string, `1951` double", ("x", "1 000", None), ("y", None, 2.5))
    got = rows(reshape.melt_years(wide, ["a"], ["1950", "1951"]))
    assert got == [("x", 1950, 1000.0), ("x", 1951, None), ("y", 1950, None), ("y", 1951, 2.5)]


def test_pivot_and_melt_are_inverse(spark):
    df = cube(spark, ("a", "511", 1950, 1), ("a", "512", 1950, 2), ("b", "511", 1950, 3))
    got = reshape.pivot_elements(df, [AREA, "timePointYears"], ["511", "512"])
    assert rows(got) == [("a", 1950, 1.0, 2.0), ("b", 1950, 3.0, None)]


def test_missing_values_are_flagged(spark):
    got = reshape.fill_missing(cube(spark, ("a", "511", 1950, None), ("b", "511", 1950, 3)))
    assert rows(got, AREA, VALUE, "flagObservationStatus") == [("a", 0.0, "O"), ("b", 3.0, "X")]


def test_alias_adds_exactly_the_aliased_rows(spark):
    df = cube(spark, ("156", "511", 1950, 1), ("4", "511", 1950, 2))
    assert rows(reshape.alias_area(df, {"156": ["1248"]}), AREA, VALUE) == [("1248", 1.0), ("156", 1.0), ("4", 2.0)]


def test_recode_by_table_and_by_dict(spark):
    df = cube(spark, ("1517", "511", 1950, 1), ("4", "511", 1950, 2))
    for mapping in ({"1517": "1505"}, table(spark, "old string, new string", ("1517", "1505"))):
        assert rows(reshape.recode(df, AREA, mapping), AREA, VALUE) == [("1505", 1.0), ("4", 2.0)]


def test_labels(spark):
    df = cube(spark, ("4", "511", 1950, 1), ("5", "511", 1950, 1), (None, "511", 1950, 1))
    labelled = reshape.add_labels(df, {AREA: table(spark, "code string, description string", ("4", "Four"))})
    assert rows(labelled, AREA, f"{AREA}_description") == [("4", "Four"), ("5", None), (None, None)]
    assert rows(reshape.unlabelled(labelled, AREA)) == [("5",), (None,)]


def test_row_ids_are_dense_and_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(5)
    got = reshape.with_row_id(df, ["v"], "n").collect()
    assert sorted((r.v, r.n) for r in got) == [(i, i + 1) for i in range(1000)]


def test_row_ids_with_many_copies(spark):
    df = spark.range(900).select(F.when(F.col("id") < 700, 5).otherwise(F.col("id")).alias("v"))
    got = reshape.with_row_id(df, ["v"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 901))
    assert [r.v for r in got] == sorted(r.v for r in got)


def test_full_join_equals_an_outer_join(spark):
    left = table(spark, "k string, a int", ("x", 1), ("y", 2), ("y", 3), (None, 4))
    right = table(spark, "k string, b int", ("y", 5), ("y", 6), ("z", 7), (None, 8))
    want = left.join(right, ["k"], "full")
    assert rows(full_join(left, right, ["k"]), "k", "a", "b") == rows(want, "k", "a", "b")


def test_group_totals_come_back_to_each_row(spark):
    df = table(spark, "k string, v int", ("a", 1), ("a", None), ("b", 2), ("b", 3), (None, 4))
    got = group_total(df, ["k"], s=strict_sum("v"))
    assert rows(got) == [("a", 1, None), ("a", None, None), ("b", 2, 5), ("b", 3, 5), (None, 4, 4)]


def test_anti_join_keeps_null_keys(spark):
    df = table(spark, "k string", ("a",), ("b",), (None,))
    assert rows(drop_listed(df, table(spark, "code string", ("a",), (None,)), "k")) == [("b",), (None,)]


def test_an_empty_list_restricts_nothing(spark):
    df = table(spark, "k string", ("a",), ("b",))
    codes = table(spark, "code string", ("a",), ("a",))
    assert rows(keep_listed_if_any(df, codes, "k")) == [("a",)]
    assert rows(keep_listed_if_any(df, codes.limit(0), "k")) == [("a",), ("b",)]
    assert rows(keep_listed_if_any(df, codes.limit(0), "k", any_of=codes)) == []


def test_splice_and_overlap(spark):
    estimates = cube(spark, ("a", "511", 1998, 1), ("a", "511", 1997, 1), ("b", "511", 1998, None))
    medium = cube(spark, ("a", "511", 1998, 2), ("a", "511", 1999, 3), ("b", "511", 1998, None))
    got = rows(splice(estimates, medium, 1998), AREA, "timePointYears", VALUE)
    assert got == [("a", 1997, 1.0), ("a", 1998, 1.0), ("a", 1999, 3.0), ("b", 1998, None)]
    differing = rows(overlap_check(estimates, medium, 1998), AREA, VALUE, "side")
    assert differing == [("a", 1.0, "estimates"), ("a", 2.0, "projections")]


def test_edge_turns_decimals_into_doubles(spark):
    df = table(spark, "v decimal(28,6), k int", (Decimal("1.5"), 1))
    assert reshape.to_edge(df).dtypes == [("v", "double"), ("k", "int")]


def test_recode_that_drops_unmapped_codes(spark):
    df = table(spark, "c string, v int", ("a", 1), ("b", 2), (None, 3))
    pairs = table(spark, "old string, new string", ("a", "x"))
    assert rows(reshape.recode(df, "c", pairs, keep_unmapped=False)) == [("x", 1)]
    assert rows(reshape.recode(df, "c", {"a": "x"}, keep_unmapped=False)) == [("x", 1)]
