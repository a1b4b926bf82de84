"""The fixed reports over the marts (Q1-Q12).

NULL always sorts last, and every order is completed by the remaining output
columns, so a cut at n rows is the same on every run.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.conditions import smallest_first
from pitwall.operators.ordering import sorted_rows


def _ordered(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[smallest_first(F.col(c)) for c in columns])


def _timed(laps: DataFrame) -> DataFrame:
    return laps.filter(F.col("lap_duration") > 0)


def lap_totals(laps: DataFrame) -> DataFrame:
    """Laps, timed laps, their seconds and the best of them, per driver number.

    All that Q3, Q4, Q9 and Q11 need of the lap fact.
    """
    timed = F.when(F.col("lap_duration") > 0, F.col("lap_duration"))
    return laps.groupBy("driver_number").agg(
        F.count(F.lit(1)).alias("laps"), F.count(timed).alias("timed_laps"),
        F.sum(timed).alias("seconds"), F.min(timed).alias("best"),
    )


def _mean_of_totals() -> Column:
    return F.try_divide(F.sum("seconds"), F.sum("timed_laps"))


def driver_list(dim: DataFrame) -> DataFrame:
    """Q1: drivers to choose from."""
    return _ordered(
        dim.select("driver_number", "full_name", "team_name").distinct(), "full_name", "driver_number", "team_name"
    )


def total_drivers(dim: DataFrame) -> DataFrame:
    """Q2."""
    return dim.agg(F.count(F.lit(1)).alias("cnt"))


def total_laps(laps: DataFrame) -> DataFrame:
    """Q3."""
    return lap_totals(laps).agg(F.coalesce(F.sum("laps"), F.lit(0)).alias("cnt"))


def average_lap(laps: DataFrame) -> DataFrame:
    """Q4: NULL without laps."""
    return lap_totals(laps).agg(_mean_of_totals().alias("avg_lap"))


def total_sessions(results: DataFrame) -> DataFrame:
    """Q5."""
    return results.agg(F.count_distinct("session_key").alias("cnt"))


def driver_standings(results: DataFrame, dim: DataFrame, n: int = 10) -> DataFrame:
    """Q6: best average final position, under the driver's present name and team.

    The dimension has one row per number, so results are summed up per number
    before the join (J5) and only those sums meet it.
    """
    per_driver = results.groupBy("driver_number").agg(
        F.count_distinct("session_key").alias("races"), F.avg("final_position").alias("avg_position")
    )
    standings = per_driver.join(dim.select("driver_number", "full_name", "team_name"), "driver_number").select(
        "driver_number", "full_name", "team_name", "races", "avg_position"
    )
    return _ordered(standings, "avg_position", "driver_number", "full_name", "team_name", "races").limit(n)


def driver_info(dim: DataFrame, driver_number: int) -> DataFrame:
    """Q7."""
    return dim.filter(F.col("driver_number") == F.lit(driver_number))


def driver_lap_series(laps: DataFrame, driver_number: int) -> DataFrame:
    """Q8: all laps of a driver in every session, by lap number."""
    mine = _timed(laps).filter(F.col("driver_number") == F.lit(driver_number))
    return sorted_rows(mine, ["lap_number", "lap_duration"])


def driver_lap_stats(laps: DataFrame, driver_number: int) -> DataFrame:
    """Q9: best, mean and number of the laps in Q8."""
    return lap_totals(laps).filter(F.col("driver_number") == F.lit(driver_number)).agg(
        F.min("best").alias("best_lap"),
        _mean_of_totals().alias("avg_lap"),
        F.coalesce(F.sum("timed_laps"), F.lit(0)).alias("total_laps"),
    )


def fastest_laps(laps: DataFrame, dim: DataFrame, n: int = 10) -> DataFrame:
    """Q10: fastest laps of drivers in the dimension."""
    timed = _timed(laps).select("session_key", "driver_number", "lap_number", "lap_duration")
    named = timed.join(dim.select("driver_number", "full_name", "team_name"), "driver_number").select(
        "session_key", "full_name", "team_name", "lap_number", "lap_duration"
    )
    return _ordered(named, "lap_duration", "session_key", "full_name", "team_name", "lap_number").limit(n)


def team_comparison(laps: DataFrame, dim: DataFrame) -> DataFrame:
    """Q11: timed laps per present team, summed up per driver number before the join."""
    totals = lap_totals(laps).filter(F.col("timed_laps") > 0).select("driver_number", "timed_laps", "seconds", "best")
    per_team = totals.join(dim.select("driver_number", "team_name"), "driver_number").groupBy("team_name").agg(
        F.sum("timed_laps").alias("total_laps"),
        _mean_of_totals().alias("avg_lap_time"),
        F.min("best").alias("best_lap"),
    )
    return _ordered(per_team, "avg_lap_time", "team_name")


def driver_lookup(dim: DataFrame, full_name: str) -> DataFrame:
    """Q12: number of a driver by name; the lowest if several share it."""
    return _ordered(dim.filter(F.col("full_name") == F.lit(full_name)).select("driver_number"), "driver_number").limit(1)
