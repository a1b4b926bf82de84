"""Choosing sessions from the catalogue."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions import conditions as c
from pitwall.functions.conditions import newest_first, smallest_first
from pitwall.schemas import RACE


def chosen_sessions(catalogue: DataFrame, year: int | None = None, session_type: str | None = None) -> DataFrame:
    """S8 without the order: an empty choice does not filter."""
    df = catalogue
    if year:
        df = df.filter(F.col("year") == F.lit(year))
    if session_type:
        df = df.filter(F.col("session_type") == F.lit(session_type))
    return df


def backfill_order(sessions: DataFrame) -> DataFrame:
    """By year (unknown as 0), then start (unknown as empty text), then key."""
    return sessions.orderBy(
        F.coalesce("year", F.lit(0)), F.coalesce("date_start", F.lit("")), smallest_first(F.col("session_key"))
    )


def summary(sessions: DataFrame) -> DataFrame:
    """Sessions per year and type."""
    counts = sessions.groupBy("year", "session_type").agg(F.count(F.lit(1)).alias("sessions"))
    return counts.orderBy(smallest_first(F.col("year")), smallest_first(F.col("session_type")))


def latest_completed_race(catalogue: DataFrame, as_of: datetime | str) -> DataFrame:
    """The race that ended last before ``as_of`` (text with an offset, or a UTC datetime), or no row.

    Ends are compared as points in time; the lowest key wins a tie.
    """
    now = c.instant(F.lit(c.utc_text(as_of)))
    ended = c.instant(F.col("date_end"))
    return (
        catalogue.filter(F.col("session_type") == F.lit(RACE)).filter(ended < now)
        .orderBy(newest_first(ended), smallest_first(F.col("session_key")))
        .limit(1)
    )
