"""Promotion: incremental copy and keyed upsert."""

from pitwall_helpers import rows
from pyspark.sql import functions as F

from pitwall.operators.upsert import upsert
from pitwall.schemas import raw_schema
from pitwall.sinks import raw as raw_sink
from pitwall.sources.tables import read_raw
from pitwall.streaming.promotion import promote, promote_by_key, read_keyed, read_promoted


def load(df, folder, entity, committed=True):
    attempt = raw_sink.new_attempt("x")
    raw_sink.append_rows(df, f"{folder}/from", entity, attempt)
    if committed:
        raw_sink.commit(df.sparkSession, f"{folder}/from", "x", attempt)
    return attempt


def test_promotion_copies_each_row_once(spark, golden, folder):
    def run(state="state"):
        promote(spark, f"{folder}/from", "laps", f"{folder}/to", f"{folder}/{state}").awaitTermination()
        return read_promoted(spark, f"{folder}/to", "laps")

    assert read_promoted(spark, f"{folder}/to", "laps").isEmpty()
    load(golden.raw.laps, folder, "laps")
    late = load(golden.raw.laps.filter("driver_number = 7"), folder, "laps", committed=False)
    assert run().count() == 12
    assert run().count() == 12
    raw_sink.commit(spark, f"{folder}/from", "x", late)
    copied = run()
    assert copied.count() == 13
    assert rows(copied) == rows(read_raw(spark, f"{folder}/from", "laps"))
    assert rows(run("other")) == rows(copied)


def test_promotion_in_small_batches(spark, golden, folder):
    for part in golden.raw.positions.randomSplit([1.0] * 4, 5):
        load(part, folder, "positions")
    query = promote(spark, f"{folder}/from", "positions", f"{folder}/to", f"{folder}/state", commits_per_batch=1)
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    assert rows(read_promoted(spark, f"{folder}/to", "positions")) == rows(golden.raw.positions)


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "b2", 1), (None, "n", 1)], "k int, v string, t int")
    changes = spark.createDataFrame([(2, "old", 2), (2, "new", 3), (3, "c", 1), (3, "c2", None)], target.schema)
    assert rows(upsert(target, changes, ["k"], "t")) == [
        (1, "a", 1), (2, "new", 3), (2, "new", 3), (3, "c2", None), (None, "n", 1),
    ]


def test_keyed_promotion_replay_and_new_checkpoint(spark, golden, folder):
    schema = raw_schema("sessions")

    def run(state="state"):
        promote_by_key(
            spark, f"{folder}/from", "sessions", f"{folder}/to", f"{folder}/{state}", ["session_key"], "ingested_at"
        ).awaitTermination()
        return read_keyed(spark, f"{folder}/to", schema)

    assert read_keyed(spark, f"{folder}/to", schema).isEmpty()
    load(golden.raw.sessions, folder, "sessions")
    assert rows(run(), "session_key") == [(1,), (2,), (3,), (4,), (5,)]
    changed = golden.raw.sessions.filter("session_key = 2").withColumn("location", F.lit("Spa"))
    load(changed.unionByName(changed.withColumn("session_key", F.lit(6).cast("bigint"))), folder, "sessions")
    expected = [(1, None), (2, "Spa"), (3, None), (4, None), (5, None), (6, "Spa")]
    assert rows(run("other"), "session_key", "location") == expected
    assert rows(run(), "session_key", "location") == expected
    assert rows(run("third"), "session_key", "location") == expected
