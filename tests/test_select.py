from helpers import cube, rows, table

from tallycube.operators import coverage, crosswalk, select
from tallycube.operators.residual import (
    RULES,
    ResidualRule,
    gap_parents,
    members_of,
    missing_residual_codes,
    parents,
    residual_areas,
)
from tallycube.plans.sync import sync

AREA = "geographicAreaM49"


def codes(spark):
    return table(
        spark,
        "code string, description string, type string, selectionOnly boolean, endDate string",
        ("4", "Four", "country", False, None),
        ("5", "Five", "country", True, None),
        ("6", None, "country", False, "1990"),
        ("9", "Nine", "region", False, None),
    )


def test_slices(spark):
    df = cube(spark, *[(a, e, y, 1) for a in "456" for e in ("511", "512") for y in (1950, 1951)])
    got = select.slice_cube(df, areas=["4", "5"], elements=["511"], years=range(1951, 1960))
    assert rows(got, AREA, "timePointYears") == [("4", 1951), ("5", 1951)]
    many = select.slice_cube(df, areas=[str(i) for i in range(4, 2000)], years=range(1950, 1951))
    assert rows(many.select(AREA).distinct()) == [("4",), ("5",), ("6",)]
    by_list = select.slice_cube(df, areas=select.codes_of(codes(spark), current=True), years=[1950])
    assert {r[0] for r in rows(by_list, AREA)} == {"4", "5"}


def test_keys_of_another_type_are_cast(spark):
    df = cube(spark, ("4", "511", 1950, 1), ("5", "511", 1950, 2))
    assert rows(select.slice_cube(df, areas=list(range(5, 3000))), "geographicAreaM49") == [("5",)]
    assert rows(select.slice_cube(df, areas=[4]), "geographicAreaM49") == [("4",)]


def test_keys_by_mode(spark):
    areas, items = select.session_keys("area", ["1"], ["i"], codes(spark))
    assert {r[0] for r in rows(areas, "code")} == {"4", "5", "6"} and items == ["i"]
    assert select.session_keys("adhoc_item", ["1"], ["i"], codes(spark)) == (["1"], ["i"])


def test_country_filters(spark):
    df = cube(spark, *[(a, "511", 1950, 1) for a in ("4", "5", "6", "9", "7")])
    assert rows(select.country_only(df, codes(spark)), AREA) == [("4",)]
    assert rows(select.unknown_codes(df, codes(spark))) == [("7",)]
    assert len(rows(select.known_codes(df, codes(spark)))) == 4


def test_validity(spark):
    df = cube(spark, *[(a, "511", y, 1) for a in ("4", "5", "6") for y in (1990, 2000)])
    spans = table(
        spark,
        "m49 string, start_year int, end_year int",
        ("4", None, 1995),
        ("4", 1990, 1990),
        ("5", 1995, None),
    )
    assert rows(select.valid_area_years(df, spans), AREA, "timePointYears") == [("4", 1990), ("5", 2000)]


def test_coverage(spark):
    df = cube(
        spark,
        *[("a", e, 1950, 1) for e in ("511", "512", "513", "551", "561")],
        ("a", "511", 1951, 1),
        ("b", "511", 1950, 1),
        ("b", "512", 1950, 1),
        ("c", "512", 1950, 1),
    )
    got = rows(coverage.missing_areas(df), AREA, "measuredElement")
    assert got == [("b", "513"), ("b", "551"), ("b", "561")]
    assert rows(coverage.one_sided(df)) == [("b", "513")]
    assert ("a", 1951, "512") in rows(coverage.missing_cells(df))
    report = rows(coverage.coverage_report(df), "kind", "message")
    # Totals and males have the same number of rows here, so no list of males is due.
    assert report == [
        ("one_sided", "Problem! Countries b are reporting only male or female population. "),
        ("rural", "Missing rural countries: b. "),
        ("urban", "Missing urban countries: b. "),
    ]


def test_report_names_every_area_once(spark):
    df = cube(spark, *[(f"a{i}", "511", 1950, 1) for i in range(500)])
    report = coverage.coverage_report(df).filter("kind = 'rural'").collect()
    assert sorted(r.code for r in report) == sorted(f"a{i}" for i in range(500))
    assert all(r.message == f"Missing rural countries: {r.code}. " for r in report)


def hierarchy(spark):
    return table(
        spark,
        "code_l3 string, code_l4 string, code_l5 string",
        ("R", "", "a"),
        ("R", None, "b"),
        ("R", "S", "c"),
        ("R", "S", "d"),
    )


def test_mixed_levels(spark):
    assert rows(parents(hierarchy(spark))) == [("R", "a", 3), ("R", "b", 3), ("S", "c", 4), ("S", "d", 4)]
    wanted = table(spark, "parent string, gap string", ("R", "512"))
    assert rows(members_of(hierarchy(spark), wanted), "parent", "member") == [("R", "a"), ("R", "b")]
    assert len(rows(members_of(hierarchy(spark), wanted, include_descendants=True))) == 4


def source(spark, *extra):
    return cube(
        spark,
        ("a", "511", 1950, 10),
        ("a", "512", 1950, 4),
        ("a", "513", 1950, 6),
        ("b", "511", 1950, 5),
        ("c", "511", 1950, 7),
        ("c", "512", 1950, 7),
        ("UR", "512", 1950, 9),
        ("UR", "513", 1950, 6),
        *extra,
    )


CONVERSION = "source_code string, residual_code string"
WEIGHTS = "flag string, weight double"


def weights(spark):
    return table(spark, WEIGHTS, ("X", 1.0), ("E", 0.5))


def test_residual_is_published_minus_members(spark):
    df = source(spark)
    conversion = table(spark, CONVERSION, ("UR", "R.01"))
    got = residual_areas(df, df, hierarchy(spark), conversion, weights(spark), RULES[:1])
    assert rows(got) == [("R.01", "512", 1950, 5.0, "X", "h"), ("R.01", "513", 1950, 0.0, "X", "h")]
    finished = ResidualRule(("512", "513"), "512", round_to=0, drop_zero=True)
    dropped = residual_areas(df, df, hierarchy(spark), conversion, weights(spark), [finished])
    assert rows(dropped, AREA, "measuredElement", "Value") == [("R.01", "512", 5.0)]


def test_one_missing_member_voids_the_residual(spark):
    df = source(spark, ("b", "513", 1950, None))
    got = residual_areas(df, df, hierarchy(spark), table(spark, CONVERSION, ("UR", "R.01")), weights(spark))
    assert rows(got, "measuredElement", "Value") == [("512", 5.0)]


def test_mixed_flags_give_one_row(spark):
    df = source(spark, ("b", "513", 1950, 1, "E"), ("b", "513", 1949, 1))
    got = residual_areas(df, df, hierarchy(spark), table(spark, CONVERSION, ("UR", "R.01")), weights(spark))
    females = got.filter("measuredElement = '513'")
    assert rows(females, "Value", "flagObservationStatus") == [(-1.0, "E")]


def test_parents_without_a_code(spark):
    df = source(spark)
    wanted = gap_parents(df, hierarchy(spark))
    assert rows(wanted) == [("R", "512")]
    assert rows(missing_residual_codes(wanted), "parent") == [("R",)]
    assert rows(missing_residual_codes(wanted, ["R"])) == []
    got = residual_areas(df, df, hierarchy(spark), table(spark, CONVERSION, ("UX", "X.01")), weights(spark))
    assert rows(got) == []


def test_sync(spark):
    df = source(spark, ("z", "511", 1950, 3))
    table_of = table(spark, "code string, compliant boolean", ("a", True), ("b", True), ("c", True), ("z", False))
    done = sync(
        df, table_of, hierarchy(spark), table(spark, CONVERSION, ("UR", "R.01")), 1949, 1948, weights(spark),
        aliases={"a": ["a2"]},
    )
    assert {r[0] for r in rows(done.cube, AREA)} == {"a", "a2", "b", "c", "R.01"}
    meta = done.metadata().collect()
    assert sorted(r.Metadata_Group for r in meta) == list(range(1, done.cube.count() + 1))
    assert {(r.geographicAreaM49, r.Metadata_Value) for r in meta if r.measuredElement == "512"} == {
        ("a", "WPP-1949. Medium fertility variant "),
        ("a2", "WPP-1949. Medium fertility variant "),
        ("c", "WPP-1949. Medium fertility variant "),
        ("R.01", "Residual variable aggregating unreported areas"),
    }
    assert rows(done.new_codes, "parent") == [("R",), ("S",)]


def test_crosswalk(spark):
    left = table(spark, "code string, source_description string", ("1", "A"), ("2", "B"), ("3", "C"), ("4", "D"))
    right = table(spark, "code string, target_description string", ("1", "A"), ("2", "b"), ("3", "B"), ("5", "E"))
    got = crosswalk.crosswalk(left, right, table(spark, "code string", ("3",), ("4",)))
    assert rows(got) == [
        ("1", "A", "A", "1", True),
        ("2", "B", "b", "2", False),
        ("3", "C", "B", "3", True),
        ("5", None, "E", None, False),
        (None, "D", None, "4", False),
    ]
    reasons = rows(crosswalk.exceptions(got), "source_code", "exception")
    assert reasons == [("2", "differs"), ("3", "differs"), ("4", "source_only"), (None, "target_only")]
    plain = crosswalk.crosswalk(left, right)
    assert rows(crosswalk.matched_elsewhere(plain), "code") == [("3",)]


def test_codes_without_description_are_there(spark):
    source = table(spark, "code string, source_description string", ("1", None), ("2", "b"))
    target = table(spark, "code string, target_description string", ("1", "a"), ("3", None))
    got = crosswalk.crosswalk(source, target)
    assert rows(got, "source_code", "code", "compliant") == [("1", "1", False), ("2", None, False), (None, "3", False)]
    assert rows(crosswalk.exceptions(got), "exception") == [("differs",), ("source_only",), ("target_only",)]


def test_memberships(spark):
    schema = "group_code string, member_code string"
    left, right = table(spark, schema, ("G", "1"), ("G", "2")), table(spark, schema, ("G", "2"), ("G", "3"), ("G", "3"))
    assert rows(crosswalk.compare_memberships(left, right)) == [("G", "1", "left"), ("G", "2", "both"), ("G", "3", "right")]


def test_countries_of_a_year(spark):
    df = cube(spark, ("4", "511", 1950, 1), ("7", "511", 1950, 2), ("5", "511", 1951, 3))
    assert rows(coverage.country_year_coverage(df, codes(spark), 1950)) == [("4", 1.0, "Four"), ("5", None, "Five"), ("7", 2.0, None)]
    spans = table(spark, "m49 string, start_year int, end_year int", ("5", 1960, None))
    assert rows(coverage.missing_countries(df, codes(spark), spans, 1950)) == [("5", "Five", 1960, None)]


def test_spans_of_an_area_are_made_disjoint(spark):
    spans = [("a", 1990, 1995), ("a", 1992, 1993), ("a", 1996, 1997), ("a", 1999, None), ("a", None, 1980), ("b", None, None), ("b", 1990, 1991),
             ("c", 2000, 1990), ("d", 1990, 1990), ("d", 1990, 1990), (None, 1, 2), ("e", 2147483647, None), ("e", 5, 6)]
    got = select.disjoint_validity(table(spark, "m49 string, start_year int, end_year int", *spans))
    assert rows(got) == sorted([("a", None, 1980), ("a", 1990, 1997), ("a", 1999, None), ("b", None, None), ("d", 1990, 1990), ("e", 2147483647, None), ("e", 5, 6)],
                               key=lambda r: tuple((v is None, str(v)) for v in r))
