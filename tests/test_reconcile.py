from helpers import cube, rows, table

from tallycube.operators import metadata, reconcile, select

AREA, YEAR = "geographicAreaM49", "timePointYears"
KEYS = [AREA, "measuredElement", YEAR]


def test_status_and_rate(spark):
    first = cube(spark, ("a", "511", 1950, 1), ("b", "511", 1950, 1), ("c", "511", 1950, 1), ("e", "511", 1950, None))
    second = cube(spark, ("a", "511", 1950, 1), ("b", "511", 1950, 3), ("d", "511", 1950, 1), ("e", "511", 1950, None))
    got = reconcile.reconcile(first, second, KEYS)
    assert rows(got, AREA, "check", "diff") == [
        ("a", "ok", None),
        ("b", "no", 2.0),
        ("c", "first_only", None),
        ("d", "second_only", None),
        ("e", "?", None),
    ]
    assert rows(reconcile.match_rate(got)) == [(5, 1, 1, 1, 1, 1, 0.2)]


def test_changes(spark):
    first = cube(spark, ("a", "511", 1950, 13), ("b", "511", 1950, 11), ("c", "511", 1950, 1))
    second = cube(spark, ("a", "511", 1950, 10), ("b", "511", 1950, 10), ("c", "511", 1950, 0))
    got = reconcile.compare(first, second, KEYS)
    assert rows(got, AREA, "difference", "change") == [("a", 3.0, 0.3), ("b", 1.0, 0.1), ("c", 1.0, None)]
    assert rows(reconcile.large_changes(got), AREA, "percent") == [("a", 30.0)]


def test_bands_are_symmetric(spark):
    schema = "label string, timePointYears int, Value decimal(28,6)"
    published = table(spark, schema, ("x", 1950, 5), ("y", 1950, 5), ("z", 1950, 5), ("only", 1950, 5))
    computed = table(spark, schema, ("x", 1950, 4), ("y", 1950, 6), ("z", 1950, 5))
    got = reconcile.area_totals(published, computed, ["label", YEAR])
    assert rows(got, "label", "band") == [("x", "above"), ("y", "below"), ("z", "within")]


def test_original_is_rounded(spark):
    stored = cube(spark, ("a", "511", 1950, 1.235), ("b", "511", 1950, 1), ("c", "511", 1950, 1))
    original = cube(spark, ("a", "511", 1950, 1.2346), ("b", "511", 1950, 2), ("d", "511", 1950, 1))
    got = reconcile.original_check(stored, original, KEYS)
    assert rows(got, AREA, "equal") == [("a", True), ("b", False), ("c", None), ("d", None)]


def test_identity(spark):
    df = cube(spark, ("a", "511", 1950, 10), ("a", "512", 1950, 4), ("a", "513", 1950, 6), ("b", "511", 1950, 5))
    residuals = cube(spark, ("R.01", "512", 1950, 2), ("R.01", "513", 1950, 3))
    members = table(spark, "parent string, member string", ("R", "a"), ("R", "b"))
    assert rows(reconcile.identity_check(df, members, residuals)) == [("R", 1950, 15.0, 15.0, True)]


def test_alias_is_not_counted_twice(spark):
    df = cube(spark, ("156", "511", 1950, 1), ("1248", "511", 1950, 1), ("4", "511", 1950, 2))
    assert rows(reconcile.control_total(select.without_areas(df, ["1248"]))) == [(2, 3.0)]


def test_metadata_priority(spark):
    df = cube(spark, ("a", "511", 2000, 1), ("a", "511", 2010, 1), ("a", "561", 2000, 1), ("R.01", "561", 2010, 1))
    got = metadata.source_texts(df, 2005, 2001, table(spark, "code string", ("R.01",)))
    assert rows(got, AREA, "measuredElement", YEAR, "Metadata_Value") == [
        ("R.01", "561", 2010, "Residual variable aggregating unreported areas"),
        ("a", "511", 2000, "WPP-2005"),
        ("a", "511", 2010, "WPP-2005. Medium fertility variant "),
        ("a", "561", 2000, "WUP-2001"),
    ]


def test_difference_of_two_cubes(spark):
    first = cube(spark, ("a", "511", 1950, 1), ("a", "511", 1951, None), ("a", "511", 1951, None))
    second = cube(spark, ("a", "511", 1950, 2), ("a", "511", 1951, None))
    got = rows(reconcile.cube_difference(first, second, ["geographicAreaM49", "timePointYears", "Value"]))
    assert got == [("a", 1950, 1.0, "first"), ("a", 1950, 2.0, "second")]


def test_totals_by_validity(spark):
    df = cube(spark, ("a", "511", 1950, 1), ("b", "511", 1950, 2), ("c", "511", 1950, 4), ("c2", "511", 1950, 4))
    spans = table(spark, "m49 string, start_year int, end_year int", ("a", None, 1990), ("b", None, 1990), ("b", 1991, None))
    got = rows(reconcile.totals_by_validity(df, spans, ["c2"]))
    assert got == [("all", 3, 7.0), ("ended", 1, 1.0), ("open", 2, 6.0)]


def test_differences_of_two_areas_stand_side_by_side(spark):
    compared = table(spark, "name string, timePointYears int, difference double", ("Asia", 1990, 1.0), ("Asia", 1991, 2.0), ("Europe", 1990, 3.0), ("Europe", 1992, 4.0), ("Africa", 1991, None))
    pairs = table(spark, "left string, right string, to_year int", ("Europe", "Asia", None), ("Asia", "Africa", 1991), ("Asia", "Africa", 1990), ("Asia", "Asia", 1990))
    got = rows(reconcile.paired_differences(compared, pairs, "name"))
    assert got == [("Asia", "Africa", 1991, 2.0, None), ("Asia", "Asia", 1990, 1.0, 1.0), ("Europe", "Asia", 1990, 3.0, 1.0)]


def test_a_task_gets_little_of_a_shuffle(spark):
    """rows fan out behind a shuffle, so what a task gets of it is held small, whatever the size of the tables."""
    from tallycube.session import configure

    mb = {k: int(configure(spark).conf.get(f"spark.sql.adaptive.{k}").rstrip("mb")) for k in ("advisoryPartitionSizeInBytes", "maxShuffledHashJoinLocalMapThreshold")}
    assert mb["advisoryPartitionSizeInBytes"] <= 8 and mb["advisoryPartitionSizeInBytes"] <= mb["maxShuffledHashJoinLocalMapThreshold"] <= 64
