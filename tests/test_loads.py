"""Loading, back-fill and refresh."""

import pytest
from pitwall_helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pitwall import pipeline
from pitwall.schemas import ENTITIES
from pitwall.sinks import raw as raw_sink
from pitwall.sinks.marts import MARTS, publish, read_mart, register_marts, schema_name
from pitwall.sources import landing
from pitwall.storage import finished_folders
from pitwall.sources.tables import commits, read_raw, read_raw_tables

STAMP = "2025-01-01 10:00:00"


@pytest.fixture
def land_golden(golden):
    def land(root, edit=None):
        raw = {entity: getattr(golden.raw, entity) for entity in ENTITIES}
        raw["sessions"] = raw["sessions"].withColumns({"year": F.lit(2024), "session_name": F.lit("S")})
        if edit:
            raw = edit(raw)
        landing.land_all(raw, root)

    return land


def test_strict_entities_need_every_column(spark):
    with pytest.raises(ValueError, match="sessions records lack session_type"):
        raw_sink.raw_shape(spark.createDataFrame([(1, "x")], "session_key long, session_name string"), "sessions")


def test_laps_are_renamed_and_absent_columns_are_null(spark):
    df = raw_sink.raw_shape(
        spark.createDataFrame([(1, 30.5, "x")], "session_key long, duration_sector_2 double, other string"), "laps"
    )
    assert df.first().asDict() == {
        "session_key": 1, "driver_number": None, "lap_number": None, "lap_duration": None,
        "segment_1_duration": None, "segment_2_duration": 30.5, "segment_3_duration": None,
        "is_pit_out_lap": None, "date_start": None, "ingested_at": None,
    }


def test_bundle_is_counted_and_visible_after_its_ledger(spark, golden, folder):
    bundle = {entity: getattr(golden.raw, entity) for entity in ENTITIES}
    raw_sink.append_rows(raw_sink.raw_shape(bundle["laps"], "laps"), folder, "laps", "a")
    assert read_raw(spark, folder, "laps").isEmpty()
    assert raw_sink.load_bundle(bundle, folder, "a") == {"sessions": 5, "drivers": 6, "laps": 12, "positions": 11}
    assert read_raw(spark, folder, "laps").count() == 12
    assert raw_sink.load_bundle(bundle, folder, "a") == {"sessions": 5, "drivers": 6, "laps": 12, "positions": 11}
    assert read_raw(spark, folder, "laps").count() == 12
    raw_sink.load_bundle(bundle, folder, "b")
    assert read_raw(spark, folder, "laps").count() == 24


def test_ledger_of_a_clean_load(spark, land_golden, folder):
    land_golden(f"{folder}/land")
    ledger = pipeline.backfill(spark, f"{folder}/land", f"{folder}/raw", "all", STAMP)
    assert rows(ledger, "session_key", "status", *ENTITIES) == [
        (1, "loaded", 1, 4, 11, 8), (2, "loaded", 1, 1, 0, 1), (3, "loaded", 1, 0, 1, 0),
        (4, "loaded", 1, 0, 0, 0), (5, "loaded", 1, 1, 0, 2),
    ]


def test_failed_session_is_left_out_and_reported(spark, land_golden, folder):
    """Session 1 has a lap beyond its limit and session 5 a position that is cut off."""
    land_golden(
        f"{folder}/land",
        lambda raw: {
            **raw,
            "laps": raw["laps"].withColumn(
                "lap_number", F.expr("if(session_key = 1 and lap_number = 5, 1000, lap_number)")
            ),
        },
    )
    with open(f"{folder}/land/positions/landing_bucket=5/cut.json", "w") as f:
        f.write('{"session_key": 5, "driver_number": 1, "pos')
    ledger = pipeline.backfill(spark, f"{folder}/land", f"{folder}/raw", "all", STAMP)
    assert rows(ledger, "session_key", "status", *ENTITIES, "error") == [
        (1, "failed", 0, 0, 0, 0, "laps: lap_number exceeds its limit of 3"),
        (2, "loaded", 1, 1, 0, 1, None),
        (3, "loaded", 1, 0, 1, 0, None),
        (4, "loaded", 1, 0, 0, 0, None),
        (5, "failed", 0, 0, 0, 0, "positions: record cannot be parsed"),
    ]
    assert rows(read_raw(spark, f"{folder}/raw", "sessions"), "session_key") == [(2,), (3,), (4,)]


@pytest.mark.parametrize(
    "file, text",
    [("laps/landing_bucket=1", '{"lap_number": 1, "sess'), ("sessions", '{"session_key": 77, "session_na')],
)
def test_unreadable_records_of_no_session_are_reported(spark, land_golden, folder, file, text):
    land_golden(f"{folder}/land")
    with open(f"{folder}/land/{file}/cut.json", "w") as f:
        f.write(text)
    ledger = pipeline.backfill(spark, f"{folder}/land", f"{folder}/raw", "all", STAMP)
    assert rows(ledger.filter("session_key is null"), "status", "error") == [
        ("failed", "unreadable records of no known session")
    ]
    assert ledger.filter("status = 'loaded'").count() == 5
    assert read_raw(spark, f"{folder}/raw", "laps").count() == 12


def test_backfill_chooses_and_does_not_repeat(spark, land_golden, folder):
    land_golden(f"{folder}/land")
    args = (spark, f"{folder}/land", f"{folder}/raw")
    first = pipeline.backfill(*args, "races", STAMP, year=2024, session_type="Race")
    assert rows(first, "session_key") == [(1,), (3,), (4,), (5,)]
    second = pipeline.backfill(*args, "rest", STAMP)
    assert rows(second, "session_key") == [(2,)]
    assert pipeline.backfill(*args, "none", STAMP).isEmpty()
    assert pipeline.backfill(*args, "again", STAMP, session_type="Race", reload=True).count() == 4
    assert rows(commits(spark, f"{folder}/raw"), "load_id") == [("again",), ("none",), ("races",), ("rest",)]
    assert read_raw(spark, f"{folder}/raw", "sessions").count() == 9


def test_replayed_backfill_keeps_what_is_committed(spark, land_golden, folder):
    """One load id for races, for all, and again; a crashed attempt and a reader in between see nothing of it."""
    land_golden(f"{folder}/land")
    args = (spark, f"{folder}/land", f"{folder}/raw", "season", STAMP)
    pipeline.backfill(*args, session_type="Race")
    reader = read_raw(spark, f"{folder}/raw", "laps")
    before = rows(reader)
    raw_sink.append_rows(reader, f"{folder}/raw", "laps", raw_sink.new_attempt("season"))
    assert rows(pipeline.backfill(*args), "session_key") == [(2,)]
    assert pipeline.backfill(*args).isEmpty()
    assert rows(reader) == before
    assert rows(read_raw(spark, f"{folder}/raw", "sessions"), "session_key") == [(1,), (2,), (3,), (4,), (5,)]
    assert read_raw(spark, f"{folder}/raw", "laps").count() == 12


@pytest.mark.parametrize(
    "file, text, error",
    [
        ("laps/landing_bucket=1", '{"lap_number": 1, "sess', "laps: record cannot be parsed"),
        ("drivers/landing_bucket=1", '{"session_key": 1}', "drivers: missing field"),
        ("positions/landing_bucket=1", '{"session_key": 1, "date": "not a time"}', "positions: date is not a time"),
    ],
)
def test_broken_records_make_fetch_and_load_fail(spark, land_golden, folder, file, text, error):
    land_golden(f"{folder}/land")
    with open(f"{folder}/land/{file}/cut.json", "w") as f:
        f.write(text)
    bundle = landing.checked_bundle(spark, f"{folder}/land", STAMP)
    with pytest.raises(PySparkException, match=error):
        raw_sink.load_bundle(bundle, f"{folder}/raw", "all")
    entity = error.split(":")[0]
    assert read_raw(spark, f"{folder}/raw", entity).isEmpty()
    if "not a time" in error:
        with pytest.raises(PySparkException, match=error):
            landing.extract_session(spark, f"{folder}/land", 1, STAMP)[entity].collect()


def test_values_beyond_their_limit_make_a_load_fail(spark, land_golden, folder):
    land_golden(
        f"{folder}/land",
        lambda raw: {**raw, "drivers": raw["drivers"].withColumn("name_acronym", F.lit("ABCDEFG"))},
    )
    with pytest.raises(PySparkException, match="name_acronym exceeds its limit of 3"):
        raw_sink.load_bundle(landing.checked_bundle(spark, f"{folder}/land", STAMP), f"{folder}/raw", "all")


def test_a_landing_folder_keeps_its_number_of_buckets(spark, golden, folder):
    landing.land(landing.to_records(golden.raw.laps, "laps"), folder, "laps", buckets=3)
    assert landing.buckets_of(spark, folder) == 3
    landing.land(landing.to_records(golden.raw.laps, "laps"), folder, "laps")
    assert landing.fetch_laps(spark, folder, 1).count() == 2 * golden.raw.laps.filter("session_key = 1").count()
    with pytest.raises(ValueError, match="3 sub-folders"):
        landing.land(landing.to_records(golden.raw.laps, "laps"), folder, "laps", buckets=4)


def test_refresh_loads_the_latest_race_once(spark, land_golden, folder):
    land_golden(f"{folder}/land")
    args = (spark, f"{folder}/land", f"{folder}/raw", f"{folder}/marts", "2024-03-10T00:00:00Z", STAMP)
    for _ in range(2):
        assert pipeline.refresh(*args) == 1
        assert read_raw(spark, f"{folder}/raw", "sessions").count() == 1
        assert read_mart(spark, f"{folder}/marts", "fct_lap_times").count() == 6
        assert read_mart(spark, f"{folder}/marts", "dim_drivers").count() == 2
        results = read_mart(spark, f"{folder}/marts", "fct_race_results")
        assert rows(results, "session_key", "driver_number", "final_position") == [(1, 1, 1), (1, 2, 5), (1, 7, 20)]


def test_reloading_a_race_multiplies_its_laps_but_not_its_results(spark, land_golden, folder):
    """Twice the laps times twice the session record; one result per driver remains."""
    land_golden(f"{folder}/land")
    args = (spark, f"{folder}/land", f"{folder}/raw", f"{folder}/marts", "2024-03-10T00:00:00Z", STAMP)
    pipeline.refresh(*args)
    pipeline.refresh(*args, reload=True)
    assert read_mart(spark, f"{folder}/marts", "fct_lap_times").count() == 24
    assert read_mart(spark, f"{folder}/marts", "fct_race_results").count() == 3
    assert read_mart(spark, f"{folder}/marts", "dim_drivers").count() == 2


def test_refresh_without_a_completed_race_does_nothing(spark, land_golden, folder):
    land_golden(f"{folder}/land")
    args = (spark, f"{folder}/land", f"{folder}/raw", f"{folder}/marts", "2020-01-01T00:00:00Z", STAMP)
    assert pipeline.refresh(*args) is None
    assert read_raw(spark, f"{folder}/raw", "laps").isEmpty()
    with pytest.raises(ValueError, match="not been published"):
        read_mart(spark, f"{folder}/marts", "dim_drivers")


def test_marts_are_versions_side_by_side(spark, golden, folder):
    assert publish(golden.dim_drivers, folder, "dim_drivers") == 1
    before = read_mart(spark, folder, "dim_drivers")
    assert publish(golden.dim_drivers.filter("driver_number = 1"), folder, "dim_drivers") == 2
    assert before.count() == 2
    assert read_mart(spark, folder, "dim_drivers").count() == 1
    assert publish(golden.dim_drivers, folder, "dim_drivers", keep=1) == 3
    assert finished_folders(spark, f"{folder}/dim_drivers", "v=") == ["000000000003"]


def test_marts_are_readable_by_name(spark, golden, folder):
    for name in MARTS:
        publish(getattr(golden, name), folder, name)
    register_marts(spark, folder, "analytics")
    assert spark.sql("SELECT count(*) FROM ANALYTICS_fct_lap_times").first()[0] == golden.fct_lap_times.count()


def test_empty_raw_tables_give_empty_marts(spark, folder):
    pipeline.build_marts(spark, f"{folder}/raw", f"{folder}/marts", STAMP)
    for name in ("dim_drivers", "fct_lap_times", "fct_race_results"):
        assert read_mart(spark, f"{folder}/marts", name).isEmpty()
    assert read_raw_tables(spark, f"{folder}/raw").laps.isEmpty()


def test_schema_names():
    assert schema_name("DEV") == "DEV"
    assert schema_name("DEV", " staging ") == "STAGING"
