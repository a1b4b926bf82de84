"""Landed records and the session catalogue."""

from datetime import datetime

import pytest
from pitwall_helpers import executed_plan, rows

from pitwall.functions.conditions import run_stamp
from pitwall.operators.checks import required_fields_report
from pitwall.schemas import REQUIRED_FIELDS, record_schema
from pitwall.sources import catalogue as cat
from pitwall.sources import landing


def write_lines(folder, entity, lines, bucket=None):
    path = folder / entity if bucket is None else folder / entity / f"landing_bucket={bucket}"
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("\n".join(lines))


SESSIONS = [
    '{"session_key": 11, "session_name": "Race", "session_type": "Race", "year": 2023, '
    '"date_start": "2023-03-05T15:00:00+03:00", "date_end": "2023-03-05T17:00:00+03:00", "unused": [1, 2]}',
    '{"session_key": 12, "session_name": "Race", "session_type": "Race", "year": 2024, '
    '"date_start": "2024-03-02T15:00:00Z", "date_end": "2024-03-02T17:00:00Z"}',
    '{"session_key": 13, "session_name": "Practice 1", "session_type": "Practice", "year": 2024, '
    '"date_start": "2024-02-29T11:30:00+00:00", "date_end": "2024-02-29T12:30:00+00:00"}',
    '{"session_key": 14, "session_name": "Race", "session_type": "Race", "year": 2024, '
    '"date_start": "2024-03-02T22:00:00+07:00", "date_end": "2024-03-03T00:00:00+07:00"}',
    '{"session_key": 15, "session_name": "Race", "session_type": "Race", "year": null, '
    '"date_start": null, "date_end": null}',
]


@pytest.fixture
def landed(tmp_path):
    write_lines(tmp_path, "sessions", SESSIONS)
    write_lines(
        tmp_path, "laps",
        ['{"session_key": 12, "driver_number": 1, "lap_number": 1, "lap_duration": 90.5, "duration_sector_1": 30.1}'],
        bucket=12,
    )
    write_lines(
        tmp_path, "laps", ['{"session_key": 28, "driver_number": 1, "lap_number": 1, "lap_duration": null}'], bucket=11
    )
    return str(tmp_path)


def test_session_filters_apply_only_if_set(spark, landed):
    def keys(**filters):
        return [r[0] for r in rows(landing.fetch_sessions(spark, landed, **filters), "session_key")]

    assert keys() == [11, 12, 13, 14, 15]
    assert keys(year=0, session_key=0) == [11, 12, 13, 14, 15]
    assert keys(year=2024) == [12, 13, 14]
    assert keys(session_key=13) == [13]
    assert keys(year=2023, session_key=13) == []


def test_no_match_is_an_empty_result_with_its_columns(spark, landed):
    nothing = landing.fetch_sessions(spark, landed, year=1900)
    assert nothing.isEmpty()
    assert nothing.columns == record_schema("sessions").names


def test_wall_clock_survives_any_offset_and_session_zone(spark, landed):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        starts = dict(rows(landing.fetch_sessions(spark, landed), "session_key", "date_start"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert starts[11] == datetime(2023, 3, 5, 15)
    assert starts[12] == datetime(2024, 3, 2, 15)
    assert starts[14] == datetime(2024, 3, 2, 22)


def test_fetching_one_session_opens_one_folder(spark, landed):
    laps = landing.fetch_laps(spark, landed, 12)
    assert rows(laps, "session_key", "lap_duration", "duration_sector_1", "is_pit_out_lap") == [(12, 90.5, 30.1, None)]
    plan = executed_plan(laps)
    assert "PartitionFilters: [isnotnull(landing_bucket" in plan


def test_year_of_the_run_is_the_default(spark, landed):
    assert rows(landing.latest_sessions(spark, landed, datetime(2023, 7, 1)), "session_key") == [(11,)]
    assert landing.latest_sessions(spark, landed, datetime(2023, 7, 1), year=2024).count() == 3


def test_bundle_is_stamped(spark, tmp_path, landed):
    for entity in ("drivers", "positions"):
        write_lines(tmp_path, entity, ['{"session_key": 12, "driver_number": 1}'], bucket=12)
    bundle = landing.extract_session(spark, landed, 12, "2025-01-01 10:00:00")
    assert list(bundle) == ["sessions", "drivers", "laps", "positions"]
    for df in bundle.values():
        assert [r["ingested_at"] for r in df.collect()] == [datetime(2025, 1, 1, 10)]


def test_run_time_is_utc_in_any_session_zone(spark, landed):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for run_ts in (datetime(2025, 1, 1, 10), datetime.fromisoformat("2025-01-01T12:00:00+02:00")):
            stamped = landing.stamped(landing.fetch_laps(spark, landed, 12), run_ts)
            assert stamped.first()["ingested_at"] == datetime(2025, 1, 1, 10)
            now = spark.range(1).select(run_stamp(run_ts).cast("long").alias("t")).first()["t"]
            assert now == 1735725600
        sessions = landing.catalogue(spark, landed)
        assert rows(cat.latest_completed_race(sessions, datetime(2024, 3, 2, 17, 0, 1)), "session_key") == [(12,)]
        assert rows(cat.latest_completed_race(sessions, datetime(2024, 3, 2, 17)), "session_key") == [(11,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_backfill_choice_and_order(spark, landed):
    sessions = landing.catalogue(spark, landed)

    def keys(*choice):
        return [r.session_key for r in cat.backfill_order(cat.chosen_sessions(sessions, *choice)).collect()]

    assert keys() == [15, 11, 13, 12, 14]
    assert keys(2024) == [13, 12, 14]
    assert keys(None, "Race") == [15, 11, 12, 14]
    assert keys(2024, "Practice") == [13]
    assert keys(0, "") == [15, 11, 13, 12, 14]


def test_summary(spark, landed):
    assert [tuple(r) for r in cat.summary(landing.catalogue(spark, landed)).collect()] == [
        (2023, "Race", 1), (2024, "Practice", 1), (2024, "Race", 2), (None, "Race", 1),
    ]


def test_latest_race_compares_instants_and_takes_the_lowest_key_of_a_tie(spark, landed):
    """Sessions 12 and 14 end at the same moment, written with different offsets."""
    sessions = landing.catalogue(spark, landed)

    def latest(as_of):
        return [r.session_key for r in cat.latest_completed_race(sessions, as_of).collect()]

    assert latest("2024-03-02T17:00:01Z") == [12]
    assert latest("2024-03-02T17:00:00Z") == [11]
    assert latest("2024-03-02T19:00:00+02:00") == [11]
    assert latest("2023-03-05T14:00:00Z") == []


def test_required_fields_count_absent_not_null(spark, tmp_path):
    write_lines(
        tmp_path, "drivers",
        ['{"driver_number": null, "full_name": "A", "team_name": "T"}', '{"driver_number": 2}', "not json"],
    )
    report = required_fields_report(
        landing.json_lines(spark, str(tmp_path), "drivers"), "drivers", list(REQUIRED_FIELDS["drivers"])
    )
    assert rows(report, "column_name", "failures") == [("driver_number", 1), ("full_name", 2), ("team_name", 2)]


def test_problems_of_records(spark, tmp_path):
    good = (
        '{"session_key": 1, "session_name": "R", "session_type": "Race", "date_start": "2024-01-01T00:00:00", '
        '"date_end": null, "gmt_offset": null, "location": null, "country_name": null, "circuit_short_name": null, '
        '"year": 2024}'
    )
    write_lines(
        tmp_path, "sessions",
        [
            good,
            good.replace('"year": 2024', '"year": 12345').replace('"session_key": 1', '"session_key": 2'),
            good.replace(', "year": 2024', "").replace('"session_key": 1', '"session_key": 3'),
            good.replace("2024-01-01T00:00:00", "soon").replace('"session_key": 1', '"session_key": 4'),
            '{"session_key": 5, "session_name": "cut off',
        ],
    )
    records = landing.checked_records(spark, str(tmp_path), "sessions")
    assert dict(rows(records, "session_key", "problem")) == {
        1: None,
        2: "year exceeds its limit of 4",
        3: "missing field year",
        4: "date_start is not a time",
        5: "record cannot be parsed",
    }
