"""Pruned landing, tables in buckets, mirrors, lag and incremental marts."""

import glob
import os
import time
from datetime import datetime

import pytest
from pitwall_helpers import executed_plan, rows
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from pitwall import pipeline
from pitwall.plans import quality
from pitwall.plans.layers import Layers
from pitwall.operators.difference import changed_rows, row_digest
from pitwall.registry import landing_of
from pitwall.schemas import ENTITIES, raw_schema
from pitwall.sinks import buckets
from pitwall.sinks import raw as raw_sink
from pitwall.sinks.check_state import checks_from_state
from pitwall.sinks.marts import MARTS, read_mart
from pitwall.sources import given, landing
from pitwall.sources.tables import commits, read_raw, read_raw_tables, session_keys
from pitwall.storage import checkpointed, delete_folder
from pitwall.streaming.lag import lag_report
from pitwall.streaming.mirror import keep_mirrored, mirror, read_mirror
from pitwall.streaming.promotion import promote, promote_by_key, read_keyed, read_promoted

STAMP = "2025-01-01 10:00:00"


def scanned(df) -> int:
    """Files of records that the scans of an executed query opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "Parquet" not in node.relation().fileFormat().toString():
            found.append(node.metrics().get("numFiles").get().value())
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


@pytest.fixture
def seasons(spark, golden, folder):
    """Sessions 1 to 5 in the years 2021 to 2025, landed with their records."""
    raw = {entity: getattr(golden.raw, entity) for entity in ENTITIES}
    raw["sessions"] = raw["sessions"].withColumns(
        {"year": (F.lit(2020) + F.col("session_key")).cast("int"), "session_name": F.lit("S")}
    )
    landing.land_all(raw, f"{folder}/land", buckets=2)
    return f"{folder}/land"


def test_a_year_and_a_session_open_only_their_folders(spark, seasons):
    assert set(landing.index_of(spark, seasons, "laps").select("session_key", "landing_bucket", "season").collect()) == {
        (1, 1, "2021"), (3, 1, "2023"),
    }
    assert scanned(landing.checked_records(spark, seasons, "laps")) == 2
    one = landing.fetch_laps(spark, seasons, 1)
    assert one.count() == 11 and scanned(one) == 1
    chosen = landing.catalogue(spark, seasons, year=2023)
    some = landing.checked_records(spark, seasons, "laps", sessions=chosen)
    assert rows(some, "session_key") == [(3,)]
    assert scanned(landing.fetch_sessions(spark, seasons, year=2023)) == 1
    # One file of laps and one of sessions.
    assert scanned(some) == 2


def test_a_back_fill_of_a_year_reads_records_of_that_year(spark, seasons, folder):
    for season in (2021, 2022, 2024, 2025):
        for path in glob.glob(f"{seasons}/keyed/*/*/season={season}/*.json") + glob.glob(f"{seasons}/keyed/*/season={season}/*.json"):
            with open(path, "w") as f:
                f.write("damaged")
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    ledger = pipeline.backfill(spark, seasons, f"{folder}/raw", "year", STAMP, year=2023)
    assert rows(ledger, "session_key", "status", *ENTITIES) == [(3, "loaded", 1, 0, 1, 0)]


def test_records_landed_before_their_session_are_found(spark, golden, folder):
    records = landing.to_records(golden.raw.laps, "laps")
    landing.land(records.filter("session_key = 3"), folder, "laps")
    raw = golden.raw.sessions.withColumn("year", F.lit(2024))
    landing.land(landing.to_records(raw, "sessions"), folder, "sessions")
    landing.land(records, folder, "laps")
    assert rows(landing.index_of(spark, folder, "laps"), "session_key", "season") == [(1, "2024"), (3, "2024"), (3, "unknown")]
    assert landing.fetch_laps(spark, folder, 3).count() == 2
    chosen = landing.catalogue(spark, folder, year=2024)
    assert landing.checked_records(spark, folder, "laps", sessions=chosen).count() == 13


def test_dropped_and_landed_records_are_read_together(spark, seasons):
    with open(f"{seasons}/laps/landing_bucket=1/more.json", "w") as f:
        f.write('{"session_key": 3, "driver_number": 9, "lap_number": 9}')
    assert rows(landing.fetch_laps(spark, seasons, 3), "driver_number") == [(1,), (9,)]
    assert landing.json_lines(spark, seasons, "laps").count() == 13


def test_entities_landed_side_by_side_write_in_folders_of_their_own(spark, golden, folder, monkeypatch):
    """The first to end removes the work files of its folder, so no two of them may write in the same."""
    written = []
    parquet, json = DataFrameWriter.parquet, DataFrameWriter.json
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: written.append(path) or parquet(self, path))
    monkeypatch.setattr(DataFrameWriter, "json", lambda self, path: written.append(path) or json(self, path))
    landing.land_all({entity: getattr(golden.raw, entity) for entity in ENTITIES}, f"{folder}/land")
    assert len(written) == len(set(written)) == 2 * len(ENTITIES)


def test_the_given_tables_are_landed_compressed(spark, sf_dir):
    root = landing_of(spark, sf_dir)
    files = glob.glob(f"{root}/keyed/**/part-*", recursive=True)
    assert files and all(path.endswith(".json.gz") for path in files)
    assert landing.json_lines(spark, root, "drivers").count() == given.raw_drivers(spark, sf_dir).count()


def test_a_record_is_parsed_once(spark, seasons):
    assert executed_plan(landing.checked_entity(spark, seasons, "drivers", STAMP)).count("from_json(") == 1


def test_an_index_of_all_entities_in_one_folder_is_still_read(spark, seasons):
    places = landing.index_of(spark, seasons, "laps").withColumn("entity", F.lit("laps"))
    checkpointed(places.select("entity", "session_key", "landing_bucket", "season")).write.parquet(f"{seasons}/index")
    delete_folder(spark, f"{seasons}/places/laps")
    assert landing.fetch_laps(spark, seasons, 1).count() == 11


def test_a_mirror_keeps_no_digests_and_takes_both_zeros_for_one(spark, raw_frame, folder):
    columns = ["session_key", "lap_number", "lap_duration"]
    laps = raw_frame("laps", columns, [(1, 1, -0.0), (1, 1, 0.0), (2, 1, 90.0), (None, None, None), (None, None, None)])
    attempt = raw_sink.new_attempt("x")
    raw_sink.append_rows(laps, f"{folder}/raw", "laps", attempt)
    raw_sink.commit(spark, f"{folder}/raw", "x", attempt)
    first = mirror(spark, f"{folder}/raw", "laps", f"{folder}/to")
    assert (first["added"], first["removed"]) == (5, 0)
    assert mirror(spark, f"{folder}/raw", "laps", f"{folder}/to") == {"added": 0, "removed": 0, "buckets": 0}
    assert "digest" not in spark.read.parquet(f"{folder}/to/rows").columns
    assert rows(read_mirror(spark, f"{folder}/to", "laps"), *columns) == rows(laps.withColumn("lap_duration", F.col("lap_duration") + 0.0), *columns)


def test_a_batch_of_keys_writes_as_many_buckets_at_most(spark, golden, folder):
    schema = raw_schema("sessions")

    def load(df):
        attempt = raw_sink.new_attempt("x")
        raw_sink.append_rows(df, f"{folder}/from", "sessions", attempt)
        raw_sink.commit(spark, f"{folder}/from", "x", attempt)
        promote_by_key(
            spark, f"{folder}/from", "sessions", f"{folder}/to", f"{folder}/state", ["session_key"], "ingested_at"
        ).awaitTermination()
        version = buckets.table_version(spark, f"{folder}/to")
        return buckets.manifest(spark, f"{folder}/to", version)

    first = load(golden.raw.sessions)
    assert set(first.values()) == {1} and 1 < len(first) <= 5
    second = load(golden.raw.sessions.filter("session_key = 2").withColumn("location", F.lit("Spa")))
    assert [v for b, v in second.items() if v == 2] == [2] and second.keys() == first.keys()
    assert len(glob.glob(f"{folder}/to/rows/v=000000000002/bucket=*")) == 1
    assert rows(read_keyed(spark, f"{folder}/to", schema), "session_key", "location") == [
        (1, None), (2, "Spa"), (3, None), (4, None), (5, None),
    ]
    before = buckets.read_buckets(spark, f"{folder}/to", schema, version=1)
    assert before.filter("location = 'Spa'").isEmpty() and before.count() == 5
    buckets.drop_unused_buckets(spark, f"{folder}/to", keep=1)
    assert read_keyed(spark, f"{folder}/to", schema).count() == 5
    assert len(glob.glob(f"{folder}/to/rows/v=000000000001/bucket=*")) == len(first) - 1


def test_differences_count_copies_and_tell_nulls_from_values(spark):
    def side(values):
        df = spark.createDataFrame(values, "a string, b string, c double")
        return df.withColumns({"digest": row_digest(["a", "b", "c"]), "copies": F.lit(1)})

    before = side([("x", None, 1.0), ("x", None, 1.0), (None, "x", 1.0), ("", None, None), ("n", "n", float("nan"))])
    after = side([("x", None, 1.0), (None, "x", 1.0), (None, "x", 1.0), (None, None, None), ("n", "n", float("nan"))])
    assert sorted(r["more"] for r in changed_rows(before, after).collect()) == [-1, -1, 1, 1]
    assert changed_rows(before, before).isEmpty()


def test_a_mirror_follows_changes_removals_and_copies(spark, golden, folder):
    source, target = f"{folder}/from", f"{folder}/to"

    def load(df, name):
        attempt = raw_sink.new_attempt(name)
        raw_sink.append_rows(df, source, "laps", attempt)
        raw_sink.commit(spark, source, name, attempt)

    def same():
        assert rows(read_mirror(spark, target, "laps")) == rows(read_raw(spark, source, "laps"))

    assert mirror(spark, source, "laps", target) == {"added": 0, "removed": 0, "buckets": 0}
    laps = golden.raw.laps
    load(laps.filter("session_key = 1"), "one")
    load(laps.filter("session_key = 3"), "three")
    assert mirror(spark, source, "laps", target)["added"] == 12
    same()
    assert mirror(spark, source, "laps", target) == {"added": 0, "removed": 0, "buckets": 0}
    load(laps.filter("session_key = 3"), "copy")
    assert mirror(spark, source, "laps", target) == {"added": 1, "removed": 0, "buckets": 1}
    same()
    raw_sink.withdraw(spark, source, "one")
    load(laps.filter("session_key = 1 and driver_number = 1").withColumn("lap_duration", F.lit(1.5)), "one")
    keep_mirrored(spark, source, "laps", target, f"{folder}/state").awaitTermination()
    same()
    assert read_mirror(spark, target, "laps").count() == 4 + 2
    for name in ("one", "three", "copy"):
        raw_sink.withdraw(spark, source, name)
    assert mirror(spark, source, "laps", target)["removed"] == 6
    same()
    assert commits(spark, source).isEmpty()


def test_lag_is_reported_and_held_by_a_stream(spark, golden, folder):
    source, target = f"{folder}/from", f"{folder}/to"

    def load(name):
        attempt = raw_sink.new_attempt(name)
        raw_sink.append_rows(golden.raw.positions, source, "positions", attempt)
        raw_sink.commit(spark, source, name, attempt)

    load("first")
    late = lag_report(spark, source, target, now=datetime(2100, 1, 1))
    assert rows(late, "load_id", "status", "in_time") == [("first", "waiting", False)]
    query = promote(spark, source, "positions", target, f"{folder}/state", continuous=True, lag_seconds=40)
    try:
        load("second")
        deadline = time.time() + 120
        while time.time() < deadline and read_promoted(spark, target, "positions").count() < 22:
            time.sleep(1)
    finally:
        query.stop()
    report = lag_report(spark, source, target)
    assert rows(report, "load_id", "status", "in_time") == [("first", "copied", True), ("second", "copied", True)]
    assert all(0 < r["lag_seconds"] < 120 for r in report.collect())
    assert rows(lag_report(spark, source, target, target_seconds=0), "in_time") == [(False,), (False,)]


def test_checks_from_state_equal_a_scan_and_read_no_raw_rows(spark, golden, folder):
    def same():
        scan = quality.data_checks(Layers(read_raw_tables(spark, folder)))
        assert rows(checks_from_state(spark, folder)) == rows(scan)

    same()
    bundle = {entity: getattr(golden.raw, entity) for entity in ENTITIES}
    raw_sink.load_bundle(bundle, folder, "all")
    same()
    again = {**bundle, "sessions": bundle["sessions"].filter("session_key in (1, 4)"), "laps": bundle["laps"].withColumn("session_key", F.lit(None).cast("bigint"))}
    raw_sink.load_bundle(again, folder, "again")
    same()
    report = {tuple(r)[:3]: r["failures"] for r in checks_from_state(spark, folder).collect()}
    assert len(report) == 22
    assert report["sessions", "session_key", "unique"] == 2 and report["stg_sessions", "session_key", "unique"] == 1
    assert report["laps", "session_key", "not_null"] == 12
    for path in glob.glob(f"{folder}/laps/*/*.parquet"):
        os.remove(path)
    assert {tuple(r)[:3]: r["failures"] for r in checks_from_state(spark, folder).collect()} == report
    raw_sink.withdraw(spark, folder, "again")
    assert sum(r["failures"] for r in checks_from_state(spark, folder).filter("check_name = 'unique'").collect()) == 0


def loaded(spark, golden, root, name, rule):
    bundle = {entity: getattr(golden.raw, entity).filter(rule) for entity in ENTITIES}
    raw_sink.load_bundle(bundle, f"{root}/raw", name)


def test_updated_marts_equal_rebuilt_ones(spark, golden, folder):
    def same():
        pipeline.build_marts(spark, f"{folder}/raw", f"{folder}/whole", STAMP)
        for mart in MARTS:
            found = read_mart(spark, f"{folder}/marts", mart).drop("updated_at")
            assert rows(found) == rows(read_mart(spark, f"{folder}/whole", mart).drop("updated_at")), mart

    def update():
        return pipeline.update_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)

    assert update()["attempts"] == 0
    same()
    loaded(spark, golden, folder, "one", "session_key = 1")
    assert update() == {"attempts": 1, "fct_lap_times": 1, "fct_race_results": 1}
    same()
    loaded(spark, golden, folder, "rest", "session_key is null or session_key <> 1")
    update()
    same()
    assert update() == {"attempts": 0, "fct_lap_times": 0, "fct_race_results": 0}
    loaded(spark, golden, folder, "again", "session_key = 1")
    assert update() == {"attempts": 1, "fct_lap_times": 1, "fct_race_results": 1}
    same()
    raw_sink.withdraw(spark, f"{folder}/raw", "rest")
    update()
    same()


def test_an_update_reads_only_attempts_of_changed_sessions(spark, golden, folder):
    """After the laps of another attempt are lost, an update that does not touch its sessions still works."""
    loaded(spark, golden, folder, "one", "session_key = 1")
    loaded(spark, golden, folder, "five", "session_key = 5")
    pipeline.update_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)
    before = read_mart(spark, f"{folder}/marts", "fct_lap_times").count()
    for path in glob.glob(f"{folder}/raw/*/attempt=one.*/*.parquet"):
        if "/keys/" not in path and "/counts/" not in path:
            with open(path, "wb") as f:
                f.write(b"damaged")
            os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    loaded(spark, golden, folder, "more", "session_key = 5")
    pipeline.update_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)
    assert read_mart(spark, f"{folder}/marts", "fct_lap_times").count() == before
    assert read_mart(spark, f"{folder}/marts", "fct_race_results").filter("session_key = 5").count() == 2
    keys = session_keys(spark, f"{folder}/raw", commits(spark, f"{folder}/raw"))
    assert rows(keys, "session_key") == [(1,), (5,), (5,)]


def test_a_whole_build_and_updates_take_turns(spark, golden, folder):
    loaded(spark, golden, folder, "one", "session_key = 1")
    pipeline.build_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)
    loaded(spark, golden, folder, "rest", "session_key <> 1")
    pipeline.update_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)
    expected = rows(golden.fct_race_results.drop("updated_at"))
    assert rows(read_mart(spark, f"{folder}/marts", "fct_race_results").drop("updated_at")) == expected
    pipeline.build_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)
    assert rows(read_mart(spark, f"{folder}/marts", "fct_race_results").drop("updated_at")) == expected
