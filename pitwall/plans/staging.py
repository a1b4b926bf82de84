"""Cleaning of the raw tables (T1-T4): lazy, recomputed per read (M1)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.functions import conditions as c
from pitwall.operators.latest import latest_per_key
from pitwall.schemas import FIRST_POSITION, LAST_POSITION, LONGEST_LAP_SECONDS, raw_names

# Order in which the attributes of a driver break a tie on the ingestion time.
# The dimension compares the same columns in the same order (see marts.dim_drivers).
DRIVER_TIE_BREAK = [
    "full_name", "name_acronym", "team_name", "team_colour", "country_code", "headshot_url", "broadcast_name",
]


def stg_sessions(raw_sessions: DataFrame) -> DataFrame:
    """Sessions with both ends known and in order."""
    return raw_sessions.filter(
        F.col("date_start").isNotNull() & F.col("date_end").isNotNull() & (F.col("date_end") >= F.col("date_start"))
    ).select(*raw_names("sessions"), F.lit(True).alias("is_valid_session"))


def known_drivers(raw_drivers: DataFrame) -> DataFrame:
    """F8: driver records with a number."""
    return raw_drivers.filter(F.col("driver_number").isNotNull())


def stg_drivers(raw_drivers: DataFrame) -> DataFrame:
    """Newest record per driver and session."""
    newest = latest_per_key(
        known_drivers(raw_drivers), ["driver_number", "session_key"], "ingested_at",
        [*DRIVER_TIE_BREAK, "ingested_at"],
    )
    return newest.select(*raw_names("drivers"))


def stg_laps(raw_laps: DataFrame) -> DataFrame:
    """Laps with a plausible time, and the sum of their segments."""
    return raw_laps.filter(c.above_up_to(F.col("lap_duration"), 0, LONGEST_LAP_SECONDS)).select(
        *raw_names("laps"),
        c.sum_of_known(*[F.col(f"segment_{n}_duration") for n in (1, 2, 3)]).alias("total_segment_time"),
        F.lit(True).alias("is_valid_lap"),
    )


def stg_positions(raw_positions: DataFrame) -> DataFrame:
    """T4: positions within the field."""
    return raw_positions.filter(c.between(F.col("position"), FIRST_POSITION, LAST_POSITION)).select(
        "session_key", "driver_number", F.col("date").alias("position_timestamp"), "position", "ingested_at",
        F.lit(True).alias("is_valid_position"),
    )


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """M1: make staging readable by name in SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
