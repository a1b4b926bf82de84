"""Layers and reports on the golden mini-fixture."""

from datetime import datetime

from pitwall_helpers import rows

from pitwall.operators.checks import not_null_report, unique_report
from pitwall.plans import marts, reports
from pitwall.schemas import NOT_NULL_RAW


def test_sessions_need_both_ends_in_order(golden):
    assert rows(golden.stg_sessions, "session_key", "is_valid_session") == [(1, True), (2, True), (5, True)]


def test_newest_driver_record_per_session(golden):
    assert rows(golden.stg_drivers, "driver_number", "session_key", "full_name", "team_name") == [
        (1, 1, "A. One", "T1"), (1, 2, "A One", "T9"), (2, 1, "B Two", "T2"), (2, 5, "B Two", "T3"),
    ]


def test_dimension_takes_newest_and_null_counts_as_newest(golden):
    expected = [(1, "A One", "T9"), (2, "B Two", "T3")]
    assert rows(golden.dim_drivers, "driver_number", "full_name", "team_name") == expected


def test_dimension_is_the_same_from_staged_drivers(golden):
    assert rows(marts.dim_drivers(golden.stg_drivers, golden.run_ts)) == rows(golden.dim_drivers)


def test_valid_laps_and_segment_sum(golden):
    staged = golden.stg_laps
    assert staged.count() == 9
    sums = {(r.driver_number, r.lap_number): r.total_segment_time for r in staged.collect() if r.session_key == 1}
    assert sums[(1, 2)] == 59.0
    assert sums[(7, 1)] == 0.0
    assert sums[(2, 5)] == 300.0


def test_lap_fact(golden):
    columns = [
        "session_key", "driver_number", "driver_name", "team_name", "lap_number", "lap_duration", "lap_position",
        "is_driver_fastest_lap", "is_session_fastest_lap",
    ]
    assert rows(golden.fct_lap_times, *columns) == sorted(
        [
            (1, 1, "A. One", "T1", 1, 90.0, 2, False, False),
            (1, 1, "A. One", "T1", 2, 89.0, 1, True, False),
            (1, 2, "B Two", "T2", 1, 91.0, 3, False, False),
            (1, 2, "B Two", "T2", 2, 89.0, 2, True, False),
            (1, 2, "B Two", "T2", 5, 300.0, 1, False, False),
            (1, 7, None, None, 1, 88.0, 1, True, True),
        ],
        key=repr,
    )


def test_staged_positions(golden):
    assert golden.stg_positions.count() == 8
    assert golden.stg_positions.columns == [
        "session_key", "driver_number", "position_timestamp", "position", "ingested_at", "is_valid_position",
    ]


def test_race_results(golden):
    assert rows(
        golden.fct_race_results, "session_key", "driver_number", "driver_name", "team_name", "final_position"
    ) == [
        (1, 1, "A. One", "T1", 1), (1, 2, "B Two", "T2", 5), (1, 7, None, None, 20),
        (5, 1, None, None, 2), (5, 2, "B Two", "T3", 1),
    ]


def test_results_of_another_session_type(golden):
    other = marts.fct_race_results(
        golden.stg_sessions, golden.stg_positions, golden.stg_drivers, session_type="Qualifying"
    )
    assert rows(other, "session_key", "driver_number", "final_position") == [(2, 1, 1)]
    wrong_case = marts.fct_race_results(
        golden.stg_sessions, golden.stg_positions, golden.stg_drivers, session_type="race"
    )
    assert wrong_case.isEmpty()


def test_run_time_is_injected(golden):
    for df in (golden.dim_drivers, golden.fct_lap_times, golden.fct_race_results):
        assert df.select("updated_at").distinct().collect()[0][0] == datetime(2025, 1, 1)


def test_run_time_defaults_to_now(golden):
    assert marts.dim_drivers(golden.stg_drivers).filter("updated_at > timestamp'2025-01-02'").count() == 2


def test_standings_use_the_dimension_and_drop_unknown_drivers(golden):
    assert [tuple(r) for r in reports.driver_standings(golden.fct_race_results, golden.dim_drivers).collect()] == [
        (1, "A One", "T9", 2, 1.5), (2, "B Two", "T3", 2, 3.0),
    ]


def test_team_comparison(golden):
    expected = [("T9", 2, 89.5, 89.0), ("T3", 3, 160.0, 89.0)]
    assert [tuple(r) for r in reports.team_comparison(golden.fct_lap_times, golden.dim_drivers).collect()] == expected


def test_other_reports(golden):
    dim, laps = golden.dim_drivers, golden.fct_lap_times
    assert [tuple(r) for r in reports.driver_list(dim).collect()] == [(1, "A One", "T9"), (2, "B Two", "T3")]
    assert reports.total_drivers(dim).first()["cnt"] == 2
    assert reports.total_laps(laps).first()["cnt"] == 6
    assert reports.average_lap(laps).first()["avg_lap"] == (90 + 89 + 91 + 89 + 300 + 88) / 6
    assert reports.total_sessions(golden.fct_race_results).first()["cnt"] == 2
    assert reports.driver_info(dim, 2).first()["team_name"] == "T3"
    assert [tuple(r) for r in reports.driver_lap_series(laps, 2).collect()] == [(1, 91.0), (2, 89.0), (5, 300.0)]
    assert tuple(reports.driver_lap_stats(laps, 2).first()) == (89.0, 160.0, 3)
    assert [tuple(r) for r in reports.fastest_laps(laps, dim, 3).collect()] == [
        (1, "A One", "T9", 2, 89.0), (1, "B Two", "T3", 2, 89.0), (1, "A One", "T9", 1, 90.0),
    ]
    assert reports.driver_lookup(dim, "B Two").first()["driver_number"] == 2


def test_reports_without_data(golden):
    none = golden.fct_lap_times.filter("false")
    assert reports.average_lap(none).first()["avg_lap"] is None
    assert tuple(reports.driver_lap_stats(none, 1).first()) == (None, None, 0)
    assert reports.driver_lap_series(none, 1).isEmpty()
    assert reports.driver_lookup(golden.dim_drivers, "nobody").isEmpty()


def test_lookup_takes_lowest_number_of_a_shared_name(spark):
    dim = spark.createDataFrame([(44, "Same"), (7, "Same"), (9, "Other")], "driver_number int, full_name string")
    assert reports.driver_lookup(dim, "Same").collect()[0][0] == 7


def test_checks(golden):
    failures = {}
    for entity, columns in NOT_NULL_RAW.items():
        for r in not_null_report(getattr(golden.raw, entity), entity, list(columns)).collect():
            failures[(r.table_name, r.column_name)] = r.failures
    assert len(failures) == 14
    assert failures[("drivers", "driver_number")] == 1
    assert failures[("drivers", "ingested_at")] == 1
    assert failures[("positions", "position")] == 1
    assert tuple(unique_report(golden.raw.sessions, "sessions", "session_key").first()) == (
        "sessions", "session_key", "unique", 0,
    )


def test_unique_ignores_null_and_counts_values_once(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert unique_report(df, "t", "k").first()["failures"] == 1
