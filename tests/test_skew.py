"""One key with most of the rows: joins must split it, and windows over it must not occur."""

import re

import pytest
from helpers import rows

from pyspark.sql import functions as F
from tallycube.operators import aggregate as agg
from tallycube.operators import groups
from tallycube.operators.joins import drop_listed, full_join, full_join_unique, group_total, keep_listed, keep_listed_if_any
from tallycube.operators.metadata import source_texts
from tallycube.operators.reshape import running_total, with_row_id
from tallycube.schema import Dims
from tallycube.sources import read_cube, write_cube


@pytest.fixture
def small_limits(spark):
    """Thresholds at which a test-sized key counts as hot, and nothing is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark):
    """Half of the rows on one key."""
    return spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 1000).cast("string").alias("k"), F.col("id").alias("v")
    )


def listed(spark):
    return spark.range(0, 500).select(F.col("id").cast("string").alias("code"))


def final_plan(df):
    df._jdf.collectToPython()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("join", [keep_listed, drop_listed])
def test_list_joins_split_a_hot_key(spark, small_limits, join):
    codes = listed(spark) if join is keep_listed else listed(spark).filter("code <> '0'")
    assert "skew=true" in final_plan(join(hot(spark), codes, "k"))


def test_a_grouping_on_the_join_key_does_not_prevent_the_split(spark, small_limits):
    df = keep_listed(hot(spark), listed(spark), "k").groupBy("k").agg(F.sum("v").alias("s"))
    assert "skew=true" in final_plan(df)


def test_totals_are_written_back_without_a_window(spark, small_limits):
    plan = final_plan(group_total(hot(spark), ["k"], s=F.sum("v")))
    assert "Window" not in plan and "skew=true" in plan


def test_full_join_splits_a_hot_key(spark, small_limits):
    left = hot(spark)
    right = spark.range(0, 1500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("w"))
    df = full_join(left, right, ["k"])
    assert "skew=true" in final_plan(df)
    want = left.join(right, ["k"], "full").agg(F.count("*"), F.sum("v"), F.sum("w"))
    assert rows(df.agg(F.count("*"), F.sum("v"), F.sum("w"))) == rows(want)


def test_a_hot_year_is_written_by_several_tasks(spark, small_limits, tmp_path):
    rows_of = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("geographicAreaM49"),
        F.when(F.col("id") % 3 == 0, 1950).otherwise(1951).alias("timePointYears"),
    )
    write_cube(rows_of, str(tmp_path / "cube"))
    files = {y: len(list((tmp_path / "cube" / f"timePointYears={y}").glob("*.parquet"))) for y in (1950, 1951)}
    assert all(2 <= n <= 100 for n in files.values())
    assert read_cube(spark, str(tmp_path / "cube")).count() == 200_000


# Codes as long as those of real lists, so that test-sized rules fill several partitions.
ITEM_DIMS = Dims(item="measuredItemCPC")


def hot_cube(spark):
    """Half of the observations are of one area, and half of one item."""
    code = lambda c: F.when(F.col("id") % 2 == 0, "0").otherwise((F.col("id") % 1000).cast("string")).alias(c)
    return spark.range(0, 200_000, 1, 8).select(
        code(ITEM_DIMS.area),
        F.lit("511").alias(ITEM_DIMS.element),
        code(ITEM_DIMS.item),
        (1950 + F.col("id") % 70).cast("int").alias(ITEM_DIMS.year),
        F.lit(1).cast("decimal(28,6)").alias(ITEM_DIMS.value),
        F.lit("X").alias(ITEM_DIMS.status),
        F.lit("h").alias(ITEM_DIMS.method),
    )


def hot_rules(spark):
    codes = spark.range(0, 1000).select(F.col("id").cast("string").alias("code"))
    members = codes.select(F.lit("G").alias("group_code"), F.col("code").alias("member_code"))
    listed = codes.select(F.lit("Population").alias("domain_name"), "code", F.lit(99).alias("flag"))
    validity = codes.select(F.col("code").alias("m49"), F.lit(1960).alias("start_year"), F.lit(None).cast("int").alias("end_year"))
    weights = spark.createDataFrame([("X", 1.0)], "flag string, weight double")
    return agg.Rules(
        area_members=members,
        item_members=members.withColumn("factor", F.lit(2.0)),
        validity=validity.unionByName(validity.withColumn("start_year", F.lit(1970))),
        flag_weights=weights,
        area_rules=listed,
        item_rules=listed,
    )


@pytest.mark.parametrize("mode", ["area", "item"])
def test_group_aggregation_splits_hot_codes(spark, small_limits, mode):
    df = agg.aggregate(hot_cube(spark), mode, hot_rules(spark), ["511"], ITEM_DIMS)
    plan = final_plan(df)
    assert "skew=true" in plan
    # The rules on an axis meet the observations in one join; others are those of flags.
    assert len(re.findall(r"SortMergeJoin(?:\(skew=true\))? \[(?:geographic|measuredItem)", plan)) == 2
    factor, valid = (1 if mode == "area" else 2), sum(1950 + k % 70 >= 1960 for k in range(200_000))
    assert rows(df.agg(F.sum(ITEM_DIMS.value))) == [(float(factor * valid),)]


def test_optional_lists_and_marks_split_hot_codes(spark, small_limits):
    codes = listed(spark)
    optional = keep_listed_if_any(hot(spark), codes, "k")
    optional.collect()
    assert "skew=true" in optional._jdf.queryExecution().executedPlan().toString()
    texts = source_texts(hot_cube(spark), 2019, 2018, codes, ITEM_DIMS)
    assert "skew=true" in final_plan(texts)


def test_full_join_of_unique_keys_reads_each_side_once(spark, small_limits):
    left = spark.range(0, 1000).select((F.col("id") * 2).alias("k"), F.lit("a").alias("v")).unionByName(spark.createDataFrame([(None, "n")] * 2, "k long, v string"))
    right = spark.range(0, 900).select((F.col("id") * 3).alias("k"), F.col("id").alias("w")).unionByName(spark.createDataFrame([(None, 7)], "k long, w long"))
    df = full_join_unique(left, right, ["k"])
    assert rows(df) == rows(left.join(right, ["k"], "full"))
    plan = final_plan(df)
    assert "Join" not in plan and plan.count("Range (") == 2
    with pytest.raises(Exception, match="a key occurs twice"):
        full_join_unique(left.unionByName(left), right, ["k"]).collect()
    with pytest.raises(ValueError):
        full_join_unique(left, left, ["k"])


def test_row_numbers_need_no_job_and_no_single_task(spark):
    df = hot(spark).withColumn("k", F.when(F.col("v") % 17 != 3, F.col("k")))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbers", "numbers")
    numbered = with_row_id(df, ["k", "v"], "n")
    assert not status.getJobIdsForGroup("numbers")
    got = numbered.orderBy("n").select("n", "k", "v").collect()
    spark.sparkContext._jsc.clearJobGroup()
    assert [r.n for r in got] == list(range(1, 200_001))
    assert [(r.k, r.v) for r in got] == [tuple(r) for r in df.orderBy("k", "v").collect()]
    assert with_row_id(df.filter("false"), ["k"], "n").count() == 0
    ties = with_row_id(df.select(F.lit(1).alias("k")), ["k"], "n")
    assert rows(ties.agg(F.count_distinct("n"), F.max("n"))) == [(200_000, 200_000)]


def test_running_totals_sum_weights(spark):
    df = spark.range(1, 5001).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w"))
    got = {r.k: r.t for r in running_total(df, ["k"], "t", "w").collect()}
    total = 0
    for k in range(1, 5001):
        assert got[k] == total
        total += k % 7


def members(spark, codes):
    """Many members in a few groups, one of them nested."""
    pairs = spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("G"), F.col("id") % codes).alias("group_code"), F.col("id").cast("string").alias("member_code")
    )
    return pairs.unionByName(spark.createDataFrame([("G0", "G1"), ("G0", None), (None, "7")], "group_code string, member_code string"))


@pytest.mark.parametrize("drop", ["aggregates", "nested"])
def test_memberships_count_as_codes_where_groups_are_dropped(spark, small_limits, drop):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64k")
    try:
        if drop == "nested":
            df = groups.clean_members(members(spark, 3))
        else:
            cube = spark.range(0, 20_000, 1, 8).select(
                F.when(F.col("id") % 4 == 0, "G2").when(F.col("id") % 4 == 1, F.col("id").cast("string")).otherwise("x").alias(ITEM_DIMS.area),
                F.when(F.col("id") % 5 == 0, "G1").when(F.col("id") % 5 > 1, "i").alias(ITEM_DIMS.item),
            )
            df = groups.drop_existing_aggregates(cube, members(spark, 3), members(spark, 3), ITEM_DIMS)
        plan = final_plan(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert df.count() == (200_000 if drop == "nested" else 12_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_many_group_codes_split_a_hot_area(spark, small_limits):
    cube = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 2 == 0, "0").otherwise(F.col("id").cast("string")).alias(ITEM_DIMS.area))
    df = groups.drop_existing_aggregates(cube, members(spark, 50_000), None, ITEM_DIMS)
    plan = final_plan(df)
    assert "skew=true" in plan and df.count() == 200_000
