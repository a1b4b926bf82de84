"""How far copies lag behind: a log of when each attempt was copied, and a report against the target."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.functions import conditions as c
from pitwall.sources.tables import commits
from pitwall.storage import exists

# Longest time a copy may lag behind when it runs continuously. A stream looks for commits so
# many times within it, which leaves the rest of the time for the copy itself.
TARGET_LAG_SECONDS = 3_600
CHECKS_PER_LAG = 4
COPIED = "attempt string, copied string, copied_at timestamp"


def copy_log(spark: SparkSession, target: str) -> DataFrame:
    """What a target has copied: the attempts, the folder of each copy, and when it was complete."""
    path = f"{target}/log"
    return spark.read.schema(COPIED).parquet(path) if exists(spark, path) else spark.createDataFrame([], COPIED)


def note_copied(target: str, attempts: DataFrame, copied: str | None = None) -> None:
    """Log attempts whose copy is complete, those not logged yet: one file."""
    new = attempts.select("attempt").distinct().join(copy_log(attempts.sparkSession, target), "attempt", "left_anti")
    row = new.select("attempt", F.lit(copied).cast("string").alias("copied"), F.current_timestamp().alias("copied_at"))
    row.coalesce(1).write.mode("append").parquet(f"{target}/log")


def lag_report(
    spark: SparkSession, raw_root: str, target: str, now: datetime | str | None = None, target_seconds: int = TARGET_LAG_SECONDS
) -> DataFrame:
    """A row per committed attempt: how long it waited for its copy, or has been waiting, and whether that is in time."""
    at = F.current_timestamp() if now is None else c.instant(F.lit(c.utc_text(now)))
    waited = F.unix_micros(F.coalesce("copied_at", at)) - F.unix_micros("committed_at")
    return (
        commits(spark, raw_root)
        .join(copy_log(spark, target).groupBy("attempt").agg(F.min("copied_at").alias("copied_at")), "attempt", "left")
        .select(
            "load_id", "attempt", "committed_at", "copied_at",
            F.when(F.col("copied_at").isNull(), F.lit("waiting")).otherwise(F.lit("copied")).alias("status"),
            (waited / 1_000_000).alias("lag_seconds"),
        )
        .withColumn("in_time", F.col("lag_seconds") <= F.lit(target_seconds))
    )
