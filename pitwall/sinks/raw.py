"""Loading records into the raw tables (K1-K6)."""

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitwall.jobs import side_by_side
from pitwall.operators.lookup import looked_up
from pitwall.schemas import ENTITIES, RAW_COLUMNS, RECORD_NAMES, STRICT_ENTITIES
from pitwall.sources.landing import UNREADABLE, checked_records, stamped
from pitwall.sources.tables import commits, withdrawals_path
from pitwall.storage import checkpointed


def raw_shape(records: DataFrame, entity: str) -> DataFrame:
    """K1-K4: the columns of the raw table, in order and under its names.

    Sessions and drivers must bring every column; in laps and positions an
    absent one is NULL. Fields the table does not have are left out.
    """
    df = records.withColumnsRenamed(RECORD_NAMES.get(entity, {}))
    absent = [name for name, _, _ in RAW_COLUMNS[entity] if name not in df.columns]
    if absent and entity in STRICT_ENTITIES:
        raise ValueError(f"{entity} records lack {', '.join(absent)}")
    return df.select(
        *[
            (F.lit(None) if name in absent else F.col(name)).cast(kind).alias(name)
            for name, kind, _ in RAW_COLUMNS[entity]
        ]
    )


def new_attempt(load_id: str) -> str:
    """A name no other attempt at this or another load has."""
    return f"{load_id}.{uuid.uuid4().hex}"


def append_rows(df: DataFrame, raw_root: str, entity: str, attempt: str) -> int:
    """Write the rows of one attempt and return their number, counted while writing.

    An attempt writes an entity once; it is an error if its folder is there already.
    """
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("error").parquet(f"{raw_root}/{entity}/attempt={attempt}")
    )
    return written.get["rows"]


def commit(spark: SparkSession, raw_root: str, load_id: str, attempt: str) -> None:
    """Add an attempt to the log, which makes its rows visible to ``read_raw``: one row, one file."""
    row = spark.createDataFrame([(load_id, attempt)], "load_id string, attempt string")
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{raw_root}/commits")


def withdraw(spark: SparkSession, raw_root: str, load_id: str) -> int:
    """Take back all attempts of a load; return their number. Its rows are no longer read, and it may be loaded again."""
    gone = [(r["attempt"],) for r in commits(spark, raw_root).filter(F.col("load_id") == load_id).collect()]
    if gone:
        log = spark.createDataFrame(gone, "attempt string").withColumn("withdrawn_at", F.current_timestamp())
        log.coalesce(1).write.mode("append").parquet(withdrawals_path(raw_root))
    return len(gone)


def load_bundle(bundle: dict[str, DataFrame], raw_root: str, load_id: str) -> dict[str, int]:
    """K5: append a bundle in order and return the rows per table.

    A load id that was committed is not loaded again; its recorded numbers are returned.
    """
    spark = bundle["sessions"].sparkSession
    done = commits(spark, raw_root).filter(F.col("load_id") == load_id).first()
    if done is not None:
        recorded = spark.read.parquet(f"{raw_root}/counts/attempt={done['attempt']}")
        return {row["table_name"]: row["loaded"] for row in recorded.collect()}
    attempt = new_attempt(load_id)
    counts = {entity: append_rows(raw_shape(bundle[entity], entity), raw_root, entity, attempt) for entity in ENTITIES}
    counts_frame(spark, counts).coalesce(1).write.parquet(f"{raw_root}/counts/attempt={attempt}")
    commit(spark, raw_root, load_id, attempt)
    return counts


def counts_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, loaded bigint")


def load_sessions(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    chosen: DataFrame,
    load_id: str,
    run_ts: datetime | str,
    session_key: int | None = None,
) -> DataFrame:
    """K6: load all records of the ``chosen`` sessions in one go; return the ledger.

    A session with a record that cannot be loaded fails as a whole and is left
    out; the others are not affected. Unreadable records that cannot be given to a
    session are reported in a ledger row without one. The first pass counts problems while
    it writes. Only if there are any, the failed sessions are found and a second attempt
    is written without them; the first one is never committed. Which sessions are chosen is
    fixed before anything is written. Only landing folders that hold chosen sessions are read;
    ``session_key`` narrows the scan further when just one session is chosen.
    """
    chosen = checkpointed(chosen.filter(F.col("session_key").isNotNull()))
    keys = chosen.select("session_key").distinct().withColumn("is_chosen", F.lit(True))
    n_chosen = chosen.count()
    keys = looked_up(keys, n_chosen)
    attempt = new_attempt(load_id)

    def marked(entity: str) -> DataFrame:
        records = checked_records(spark, landing_root, entity, session_key, sessions=keys)
        return records.join(keys, "session_key", "left")

    def wanted(entity: str) -> DataFrame:
        return marked(entity).filter("is_chosen")

    def write_good(entity: str) -> tuple[int, int]:
        seen = Observation()
        is_lost = F.col("session_key").isNull()
        if entity == "sessions":
            # An unreadable session is not in the catalogue, so it cannot have been chosen.
            is_lost = is_lost | (F.col("is_chosen").isNull() & (F.col("problem") == UNREADABLE))
        counted = marked(entity).observe(
            seen,
            F.count(F.when(F.col("is_chosen"), F.col("problem"))).alias("problems"),
            F.count(F.when(is_lost, F.col("problem"))).alias("lost"),
        )
        good = counted.filter("is_chosen and problem is null")
        append_rows(raw_shape(stamped(good, run_ts), entity), raw_root, entity, attempt)
        return seen.get["problems"], seen.get["lost"]

    def write_again(entity: str) -> None:
        good = wanted(entity).filter(F.col("problem").isNull()).join(
            looked_up(failed.select("session_key"), n_chosen), "session_key", "left_anti"
        )
        append_rows(raw_shape(stamped(good, run_ts), entity), raw_root, entity, attempt)

    problems, lost = map(sum, zip(*side_by_side(spark, write_good, ENTITIES)))
    failed = None
    if problems:
        failed = checkpointed(_failed_sessions(wanted))
        attempt = new_attempt(load_id)
        side_by_side(spark, write_again, ENTITIES)

    ledger = _ledger(spark, raw_root, chosen, n_chosen, failed, attempt)
    if lost:
        unplaced = (None, None, None, "failed", *[0] * len(ENTITIES), "unreadable records of no known session")
        ledger = ledger.unionByName(spark.createDataFrame([unplaced], ledger.schema))
    path = f"{raw_root}/ledger/attempt={attempt}"
    ledger.write.parquet(path)
    commit(spark, raw_root, load_id, attempt)
    return spark.read.parquet(path)


def _failed_sessions(wanted) -> DataFrame:
    """One row per session with a problem, and the first of its messages."""
    messages = [
        wanted(entity).filter(F.col("problem").isNotNull()).select(
            "session_key", F.concat(F.lit(f"{entity}: "), F.col("problem")).alias("error")
        )
        for entity in ENTITIES
    ]
    return reduce(DataFrame.unionByName, messages).groupBy("session_key").agg(F.min("error").alias("error"))


def _ledger(
    spark: SparkSession, raw_root: str, chosen: DataFrame, n_chosen: int, failed: DataFrame | None, attempt: str
) -> DataFrame:
    """Status, error and loaded rows per chosen session, counted from what was written."""
    sessions = chosen.groupBy("session_key").agg(
        F.max("session_name").alias("session_name"), F.max("year").alias("year")
    )
    if failed is None:
        sessions = sessions.withColumn("error", F.lit(None).cast("string"))
    else:
        sessions = sessions.join(looked_up(failed, n_chosen), "session_key", "left")
    for entity in ENTITIES:
        loaded = spark.read.parquet(f"{raw_root}/{entity}/attempt={attempt}")
        counts = loaded.groupBy("session_key").agg(F.count(F.lit(1)).alias(entity))
        sessions = sessions.join(looked_up(counts, n_chosen), "session_key", "left").withColumn(
            entity, F.coalesce(entity, F.lit(0).cast("bigint"))
        )
    status = F.when(F.col("error").isNull(), F.lit("loaded")).otherwise(F.lit("failed"))
    return sessions.select("session_key", "session_name", "year", status.alias("status"), *ENTITIES, "error")
