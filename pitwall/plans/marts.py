"""The dimension and the two facts."""

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions import conditions as c
from pitwall.operators.copies import fold_copies, split_chunks, unfold
from pitwall.operators.latest import latest_per_key
from pitwall.operators.numbering import number_rows
from pitwall.schemas import RACE

DRIVER_ATTRIBUTES = ["full_name", "name_acronym", "team_name", "team_colour", "country_code", "headshot_url"]
SEGMENTS = ["segment_1_duration", "segment_2_duration", "segment_3_duration"]


def dim_drivers(drivers: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """T5: newest record per driver number over all sessions.

    ``drivers`` may be staged drivers or all raw records with a number. Both give
    the same rows, since staging keeps the newest per session under the same
    order; the raw records save the shuffle by session.
    """
    newest = latest_per_key(drivers, ["driver_number"], "ingested_at", DRIVER_ATTRIBUTES)
    return newest.withColumn("updated_at", c.run_stamp(run_ts))


NEWEST_COLUMNS = ["driver_number", "ingested_at", *DRIVER_ATTRIBUTES]


def newest_drivers(drivers: DataFrame) -> DataFrame:
    """T5 before its stamp, with the ingestion times. The newest of these and of other records is the newest of all."""
    newest = latest_per_key(drivers, ["driver_number"], "ingested_at", [*DRIVER_ATTRIBUTES, "ingested_at"])
    return newest.select(*NEWEST_COLUMNS)


def racing_laps(stg_laps: DataFrame) -> DataFrame:
    """laps known not to leave the pit."""
    return stg_laps.filter(c.is_false(F.col("is_pit_out_lap")))


# Laps of one number whose durations fall into the same so many seconds are ranked by one task.
RANK_SLICE_SECONDS = 0.25


def fct_lap_times(
    stg_laps: DataFrame,
    stg_sessions: DataFrame,
    stg_drivers: DataFrame,
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """One row per racing lap and session record, with its rank and the fastest-lap flags.

    A session recorded n times multiplies its laps by n, and a lap of an unknown
    driver stays. How it scales:

    - The fastest laps (W4, W5) are aggregates joined back, not windows, so no task
      ever holds a whole session.
    - Everything known per session and driver (session attributes J1, driver J2,
      fastest laps) is joined on that level first; the laps meet it in one join.
    - Laps are ranked (W3) before that join, while their rows are narrow. Repeated
      session records only come in as a factor: a lap ranked k takes the places
      after those of the k - 1 laps before it.
    """
    laps = racing_laps(stg_laps).select("session_key", "driver_number", "lap_number", "lap_duration", *SEGMENTS)
    ranked = number_rows(
        laps, ["session_key", "lap_number"], ["lap_duration", "driver_number", *SEGMENTS], "lap_rank",
        cut=F.floor(F.col("lap_duration") / RANK_SLICE_SECONDS),
    )
    same_entry = (F.col("session_key") == F.col("entry_session")) & c.same_or_both_null(
        F.col("driver_number"), F.col("entry_driver")
    )
    facts = unfold(ranked.join(_lap_entries(laps, stg_sessions, stg_drivers), same_entry), "place")
    position = (F.col("lap_rank") - 1) * F.col("records") + F.col("records_before") + F.col("place") + 1
    return facts.select(
        "session_key",
        "driver_number",
        "driver_name",
        "team_name",
        "lap_number",
        "lap_duration",
        *SEGMENTS,
        "session_type",
        "circuit_short_name",
        "year",
        position.alias("lap_position"),
        c.equals_or_false(F.col("lap_duration"), F.col("driver_fastest_lap")).alias("is_driver_fastest_lap"),
        c.equals_or_false(F.col("lap_duration"), F.col("session_fastest_lap")).alias("is_session_fastest_lap"),
        c.run_stamp(run_ts).alias("updated_at"),
    )


def _lap_entries(laps: DataFrame, stg_sessions: DataFrame, stg_drivers: DataFrame) -> DataFrame:
    """What the lap fact looks up per session and driver, repeated session records as chunks of copies."""
    driver_best = laps.groupBy("session_key", "driver_number").agg(
        F.min("lap_duration").alias("driver_fastest_lap")
    )
    session_best = driver_best.groupBy("session_key").agg(
        F.min("driver_fastest_lap").alias("session_fastest_lap")
    )
    entries = (
        driver_best.join(_session_records(stg_sessions).join(session_best, "session_key"), "session_key")
        .join(_driver_names(stg_drivers), ["session_key", "driver_number"], "left")
        .withColumnsRenamed({"session_key": "entry_session", "driver_number": "entry_driver"})
    )
    return split_chunks(entries)


def _session_records(stg_sessions: DataFrame) -> DataFrame:
    """Differing records per session with their ``copies``, all ``records`` of the session, and those before."""
    attributes = ["session_type", "circuit_short_name", "year"]
    folded = fold_copies(stg_sessions, ["session_key", *attributes])
    of_session = Window.partitionBy("session_key")
    before = of_session.orderBy(*[c.smallest_first(F.col(a)) for a in attributes]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return folded.withColumns(
        {
            "records": F.sum("copies").over(of_session),
            "records_before": F.coalesce(F.sum("copies").over(before), F.lit(0)),
        }
    )


def _driver_names(stg_drivers: DataFrame) -> DataFrame:
    return stg_drivers.select("session_key", "driver_number", F.col("full_name").alias("driver_name"), "team_name")


def fct_race_results(
    stg_sessions: DataFrame,
    stg_positions: DataFrame,
    stg_drivers: DataFrame,
    session_type: str = RACE,
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """Last valid position per race and driver.

    Sessions are reduced to one record per race, and positions to those of races before
    anything else is done with them. Then each task reduces its positions to one per session
    and driver, which takes a sort of its rows, and no join sees a key more often than once
    per driver (J3, J4).
    """
    attributes = ["session_name", "circuit_short_name", "location", "year"]
    races = (
        stg_sessions.filter(F.col("session_type") == F.lit(session_type)).groupBy("session_key")
        .agg(F.max(F.struct(*attributes)).alias("race"))
        .select("session_key", *[F.col(f"race.{a}").alias(a) for a in attributes])
    )
    of_races = stg_positions.join(races.select("session_key"), "session_key", "left_semi")
    last = latest_per_key(of_races, ["session_key", "driver_number"], "position_timestamp", ["position"])
    return (
        last.join(races, "session_key")
        .join(_driver_names(stg_drivers), ["session_key", "driver_number"], "left")
        .select(
            "session_key",
            "driver_number",
            "driver_name",
            "team_name",
            F.col("position").alias("final_position"),
            "session_name",
            "circuit_short_name",
            "location",
            "year",
            c.run_stamp(run_ts).alias("updated_at"),
        )
    )
