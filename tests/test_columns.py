import pytest
from helpers import rows, table

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from tallycube import functions as X
from tallycube.schema import Dims, dim_name


def test_numbers_with_blank_separators(spark):
    df = table(spark, "t string", ("1 234.5",), ("x",), ("",), ("NA",), ("nan",), ("-3",), (None,))
    got = {r.t: r.v for r in df.select("t", X.clean_number("t").cast("double").alias("v")).collect()}
    assert got == {"1 234.5": 1234.5, "x": None, "": None, "NA": None, "nan": None, "-3": -3.0, None: None}


@pytest.mark.parametrize("text", ["1e25", "0.0000004", "1 234.0000001", "123456789012345678901234567890123456", "4e-7"])
def test_a_number_that_loses_digits_is_an_error(spark, text):
    df = table(spark, "t string", (text,))
    with pytest.raises(SparkRuntimeException):
        df.select(X.clean_number("t")).collect()


def test_numbers_up_to_the_last_decimal(spark):
    df = table(spark, "t string", ("0.000001",), ("1.50000000",), ("1e3",), (".5",))
    assert [str(r[0]) for r in df.select(X.clean_number("t")).collect()] == ["0.000001", "1.500000", "1000.000000", "0.500000"]


def test_years(spark):
    df = table(spark, "t string", ("1998",), ("year",))
    assert rows(df.select(X.clean_year("t").alias("y"))) == [(1998,), (None,)]


def test_residual_suffix(spark):
    df = table(spark, "c string", ("101.01",), ("011.01",), ("10101",))
    got = [tuple(r) for r in df.select("c", X.base_code("c").alias("b")).collect()]
    assert got == [("101.01", "101"), ("011.01", "011"), ("10101", "10101")]
    assert rows(df.limit(1).select(X.residual_code(X.base_code("c")))) == [("101.01",)]


def test_sums_and_missing_values(spark):
    df = table(spark, "k string, v int", ("a", 1), ("a", None), ("b", 2), ("c", None))
    got = df.groupBy("k").agg(X.strict_sum("v").alias("s"), X.lenient_sum("v").alias("l"))
    assert rows(got, "k", "s", "l") == [("a", None, 1), ("b", 2, 2), ("c", None, 0)]


def test_changes(spark):
    df = table(spark, "a double, b double", (3.0, 2.0), (1.0, 0.0))
    assert rows(df.select(X.relative_change("a", "b"), X.percent_change("a", "b"))) == [(0.5, 50.0), (None, None)]


def test_release_text_skips_a_missing_variant_only(spark):
    df = table(spark, "v string", ("Estimates",), (None,), ("NAtional",))
    got = rows(df.select(X.release_text(F.lit("WPP"), F.col("v")).alias("t")))
    assert got == [("WPP",), ("WPP-Estimates",), ("WPP-NAtional",)]


def test_dimensions_are_found_by_pattern():
    pair = Dims.discover(["geographicAreaM49", "measuredElement", "timePointYears", "Value", "flagObservationStatus", "flagMethod"])
    assert (pair.area, pair.item, pair.status, pair.method) == ("geographicAreaM49", None, "flagObservationStatus", "flagMethod")
    single = Dims.discover(["geographicAreaM49", "measuredElementTrade", "measuredItemCPC", "timePointYears", "Value", "flagOffice"])
    assert (single.element, single.item, single.flag, single.status) == (
        "measuredElementTrade",
        "measuredItemCPC",
        "flagOffice",
        None,
    )
    assert dim_name(["a"], "item", required=False) is None


def test_numbers_with_exponents_keep_their_decimals(spark):
    texts = ["1e-3", "1.5e-2", "-2.5E-5", "12e2", "1e-6", "0e-30", "0.0000010"]
    got = table(spark, "t string", *[(t,) for t in texts]).select(X.clean_number("t")).collect()
    assert [float(r[0]) for r in got] == [0.001, 0.015, -0.000025, 1200.0, 0.000001, 0.0, 0.000001]
    for lost in ("1e-7", "1.5e-6", "3e-19", "1e30", "0.0000001"):
        with pytest.raises(SparkRuntimeException):
            table(spark, "t string", (lost,)).select(X.clean_number("t")).collect()
