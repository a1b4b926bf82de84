"""Hot groups: results must not change, and no task may get a whole hot group."""

import random

import pytest
from pitwall_helpers import executed_plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwall.operators.copies import fold_copies, split_chunks, unfold
from pitwall.operators.latest import latest_per_key
from pitwall.operators.numbering import number_rows
from pitwall.operators.ordering import sorted_rows
from pitwall.plans import marts, reports, staging
from pitwall.registry import layers
from pitwall.sources import given


@pytest.fixture(scope="module")
def hot_laps(spark):
    """A third of the rows in one group, a third copies of one row, NULL keys and values."""
    rng = random.Random(7)
    data = [(1, 1, rng.randint(1, 40), rng.randint(1, 3)) for _ in range(2000)]
    data += [(2, 5, 90, 1)] * 2000
    data += [(rng.randint(3, 60), rng.choice([1, 2, None]), rng.choice([80, 81, None]), 1) for _ in range(1500)]
    data += [(None, None, rng.randint(1, 9), 2) for _ in range(500)]
    return spark.createDataFrame(data, "s bigint, n int, t int, d int").repartition(6)


def test_numbers_of_hot_groups_equal_those_of_a_window(hot_laps):
    keys, order = ["s", "n"], ["t"]
    window = Window.partitionBy(*keys).orderBy(F.col("t").asc_nulls_last(), F.col("d").asc_nulls_last())
    brute = hot_laps.withColumn("k", F.row_number().over(window).cast("bigint"))
    for cut in (F.col("t"), F.floor(F.col("t") / 7), F.lit(None)):
        numbered = number_rows(hot_laps, keys, order, "k", cut)
        assert rows(numbered) == rows(brute.select(*numbered.columns))


def test_hot_groups_are_spread_over_tasks(spark, hot_laps):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        sliced = number_rows(hot_laps, ["s", "n"], ["t"], "k", F.col("t"))
        of_group = sliced.filter("s = 1 and n = 1").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set(key, "true")
    assert len(of_group) > 2
    assert max(r["count"] for r in of_group) < 1500


def test_numbering_keeps_values_and_runs_no_job(spark):
    df = spark.createDataFrame([(1, 0.0, -0.0), (1, -0.0, 1.0), (1, None, -0.0)], "k int, t double, g double")
    group = "planning"
    spark.sparkContext.setJobGroup(group, group)
    numbered = number_rows(df, ["k"], ["t"], "n", F.floor("t"))
    started = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not started
    assert sorted(str(tuple(r)) for r in numbered.select("t", "g").collect()) == sorted(
        str(tuple(r)) for r in df.select("t", "g").collect()
    )


def test_copies_fold_and_unfold(spark):
    df = spark.createDataFrame([("a",)] * 7 + [("b",)], "v string")
    chunks = split_chunks(fold_copies(df, ["v"]), chunk_rows=3)
    assert rows(chunks) == [("a", 0, 3), ("a", 3, 3), ("a", 6, 1), ("b", 0, 1)]
    assert rows(unfold(chunks, "place")) == [("a", i) for i in range(7)] + [("b", 0)]


def test_sorted_rows_keep_all_copies_in_order(hot_laps):
    result = [tuple(r) for r in sorted_rows(hot_laps.select("n", "t"), ["n", "t"]).collect()]
    last = float("inf")
    expected = sorted(
        (tuple(r) for r in hot_laps.select("n", "t").collect()),
        key=lambda r: tuple(last if v is None else v for v in r),
    )
    assert result == expected


def test_one_session_with_most_laps(spark, sf_dir):
    """All laps of even sessions moved into one: flags and ranks still equal the window form."""
    y = layers(spark, sf_dir)
    laps = y.stg_laps.withColumn("session_key", F.expr("if(session_key % 2 = 0, 2L, session_key)"))
    fact = marts.fct_lap_times(laps, y.stg_sessions, y.stg_drivers, "2025-01-01").select(
        "session_key", "driver_number", "lap_number", "lap_duration", *marts.SEGMENTS, "lap_position",
        "is_driver_fastest_lap", "is_session_fastest_lap",
    )
    lap = Window.partitionBy("session_key", "lap_number").orderBy("lap_duration", "driver_number", *marts.SEGMENTS)
    driver, session = Window.partitionBy("session_key", "driver_number"), Window.partitionBy("session_key")
    brute = marts.racing_laps(laps).join(y.stg_sessions.select("session_key"), "session_key").select(
        "session_key", "driver_number", "lap_number", "lap_duration", *marts.SEGMENTS,
        F.row_number().over(lap).cast("bigint").alias("lap_position"),
        (F.col("lap_duration") == F.min("lap_duration").over(driver)).alias("is_driver_fastest_lap"),
        (F.col("lap_duration") == F.min("lap_duration").over(session)).alias("is_session_fastest_lap"),
    )

    assert rows(fact.drop(*marts.SEGMENTS)) == rows(brute.drop(*marts.SEGMENTS))


def test_repeated_session_records_multiply_the_laps(spark, golden, raw_frame):
    """Three records of session 1, one of them different: every lap three times, places taken in turn."""
    again = golden.raw.sessions.filter("session_key = 1")
    sessions = golden.raw.sessions.unionByName(again).unionByName(again.withColumn("year", F.lit(2024)))
    fact = marts.fct_lap_times(golden.stg_laps, staging.stg_sessions(sessions), golden.stg_drivers)
    assert fact.count() == 18
    for (lap_number,), laps in {(1,): 3, (2,): 2, (5,): 1}.items():
        places = [r[0] for r in fact.filter(F.col("lap_number") == lap_number).select("lap_position").collect()]
        assert sorted(places) == list(range(1, 3 * laps + 1))
    fastest = fact.filter("lap_number = 1 and driver_number = 7").select("lap_position", "year")
    assert rows(fastest) == [(1, 2024), (2, None), (3, None)]


def test_latest_is_reduced_before_the_shuffle(spark, sf_dir):
    plan = executed_plan(staging.stg_drivers(given.raw_drivers(spark, sf_dir)))
    assert plan.count("Exchange") == 1
    assert "partial_max" in plan[plan.index("Exchange"):]


def test_latest_breaks_ties_by_columns_and_null_is_newest(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "x"), (2, 9, "y"), (3, 1, None), (3, 1, "q")],
        "k int, t int, v string",
    )
    assert rows(latest_per_key(df, ["k"], "t", ["v"])) == [(1, "b"), (2, "x"), (3, "q")]


def test_skewed_join_partitions_are_split(spark, sf_dir):
    """Without broadcast, the fact join of a hot session and driver is split by Spark at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    y = layers(spark, sf_dir)
    laps = y.raw.laps.withColumn("session_key", F.expr("if(session_key % 3 = 0, 3L, session_key)"))
    laps = laps.withColumn("driver_number", F.expr("if(session_key = 3, 4, driver_number)"))
    more = F.explode(F.sequence(F.lit(1), F.lit(20)))
    laps = laps.withColumn("step", more).withColumn("segment_1_duration", F.rand(3)).drop("step").repartition(8)
    stg_laps = staging.stg_laps(laps)
    expected = reports.total_laps(
        marts.fct_lap_times(stg_laps, y.stg_sessions, y.stg_drivers)
    ).first()["cnt"]
    before = {key: spark.conf.get(key) for key in settings if spark.conf.get(key, None) is not None}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = marts.fct_lap_times(stg_laps, y.stg_sessions, y.stg_drivers)
        assert len(fact.collect()) == expected
        assert "skew=true" in executed_plan(fact)
    finally:
        for key in settings:
            spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)
