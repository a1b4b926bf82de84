"""What Spark makes of the plans over stored raw tables."""

import pytest
from pitwall_helpers import executed_plan

from pitwall.plans import marts, reports, staging
from pitwall.plans.layers import Layers, RawTables
from pitwall.schemas import ENTITIES
from pitwall.session import sized_for
from pitwall.sinks.marts import publish, read_mart
from pitwall.sources import given


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    raw = given.raw_tables(spark, sf_dir)
    for entity in ENTITIES:
        getattr(raw, entity).write.parquet(f"{root}/{entity}")
    return Layers(
        RawTables(**{e: (lambda e=e: spark.read.parquet(f"{root}/{e}")) for e in ENTITIES}), "2025-01-01"
    )


def test_validity_rules_reach_the_scan(stored):
    assert "PushedFilters: [IsNotNull(lap_duration), GreaterThan(lap_duration,0.0), " \
        "LessThanOrEqual(lap_duration,300.0)]" in executed_plan(stored.stg_laps)
    assert "PushedFilters: [IsNotNull(position), GreaterThanOrEqual(position,1), LessThanOrEqual(position,20)]" \
        in executed_plan(stored.stg_positions)
    assert "IsNotNull(date_start), IsNotNull(date_end)" in executed_plan(stored.stg_sessions)


def test_pit_rule_reaches_the_scan(stored):
    assert "Not(EqualTo(is_pit_out_lap,true))" in executed_plan(marts.racing_laps(stored.stg_laps))


def test_unused_driver_lookup_is_dropped(stored):
    plan = executed_plan(reports.total_sessions(stored.fct_race_results))
    assert "full_name" not in plan
    assert "LeftOuter" not in plan


def test_top_rows_are_not_sorted_in_full(stored):
    plan = executed_plan(reports.fastest_laps(stored.fct_lap_times, stored.dim_drivers))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_team_comparison_sums_up_before_the_join(stored):
    plan = executed_plan(reports.team_comparison(stored.fct_lap_times, stored.dim_drivers))
    assert "partial_count(1)" not in plan[:plan.index("Join [driver_number")]
    assert "Join [driver_number" in plan


def test_more_input_asks_for_more_partitions(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        assert sized_for(spark, 10).conf.get(key) == before
        assert sized_for(spark, 300 * 128 * 1024 * 1024).conf.get(key) == "301"
        assert sized_for(spark, 10**14).conf.get(key) == "745059"
        assert sized_for(spark, 10).conf.get(key) == before
        spark.conf.set(key, "7")
        assert sized_for(spark, 10).conf.get(key) == "7"
    finally:
        spark.conf.set(key, before)


def test_positions_of_other_sessions_go_before_the_reduction(spark, stored):
    """Races are found below the first reduction of positions."""
    plan = executed_plan(stored.fct_race_results)
    assert "LeftSemi" in plan[plan.index("partial_max"):]


def test_laps_are_shuffled_twice_for_the_fact(spark, stored):
    """Once for the rank, by slice, and once for all look-ups, also when nothing is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = executed_plan(marts.fct_lap_times(stored.stg_laps, stored.stg_sessions, stored.stg_drivers))
    finally:
        spark.conf.set(key, before)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    wide = [line for line in exchanges if "__place" in line or "coalesce(driver_number" in line]
    # The slices' sizes are counted before they are shuffled, and their sums shuffled back.
    assert len(wide) <= 5
    assert "Window [row_number()" in plan
    assert "min(lap_duration" not in plan[plan.index("Window [row_number()"):plan.index("Window [row_number()") + 200]


def test_no_python_in_the_plans(stored):
    for df in (stored.fct_lap_times, stored.fct_race_results, stored.dim_drivers):
        assert "Python" not in executed_plan(df)


def test_reports_on_a_stored_fact_filter_in_the_scan(spark, stored, tmp_path):
    publish(stored.fct_lap_times, str(tmp_path), "fct_lap_times")
    fact = read_mart(spark, str(tmp_path), "fct_lap_times")
    plan = executed_plan(reports.driver_lap_stats(fact, 9))
    assert "EqualTo(driver_number,9)" in plan
    assert "ReadSchema: struct<driver_number:int,lap_duration:double>" in plan


def test_dimension_needs_one_shuffle(stored):
    assert executed_plan(stored.dim_drivers).count("Exchange") == 1
    assert executed_plan(marts.dim_drivers(stored.stg_drivers)).count("Exchange") == 2


def test_staging_views_are_readable_by_name(spark, stored):
    staging.register_views(spark, {"stg_positions": stored.stg_positions})
    assert spark.sql("SELECT count(*) FROM stg_positions").first()[0] == stored.stg_positions.count()
