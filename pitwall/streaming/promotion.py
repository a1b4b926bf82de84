"""Copying raw tables to the next environment.

The stream follows the commit log of a raw table, not its folders: a batch is what was
committed since the last one, and copies exactly the attempts that these commits name. Rows
of attempts that failed or are still being written are never copied.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitwall.operators.upsert import upsert
from pitwall.schemas import raw_names, raw_schema
from pitwall.sinks.buckets import (
    BUCKETS, bucket_count, bucket_of, complete, new_version, read_buckets, replace_buckets, table_version,
)
from pitwall.sources.tables import COMMITS, of_attempts, read_attempts
from pitwall.storage import exists, next_version, read_version, write_version
from pitwall.streaming.lag import CHECKS_PER_LAG, TARGET_LAG_SECONDS, copy_log, note_copied


def _new_commits(spark: SparkSession, raw_root: str, commits_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(COMMITS)
    if commits_per_batch:
        reader = reader.option("maxFilesPerTrigger", commits_per_batch)
    return reader.parquet(f"{raw_root}/commits")


def promote(
    spark: SparkSession,
    raw_root: str,
    entity: str,
    target_dir: str,
    checkpoint_dir: str,
    continuous: bool = False,
    commits_per_batch: int | None = None,
    lag_seconds: int = TARGET_LAG_SECONDS,
) -> StreamingQuery:
    """Copy what is newly committed in a raw table, each attempt exactly once.

    Runs once over all new commits, or on as a stream that looks for them several times within
    the target lag; ``lag_report`` tells how long each attempt waited. An attempt keeps
    its folder name in the target, so a repeated batch and a new checkpoint folder find what is
    there already; ``read_promoted`` reads the target. Both folders must lie on shared storage.
    """

    def copy(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        new = batch.select("attempt").distinct().join(copy_log(session, target_dir).select("attempt"), "attempt", "left_anti")
        rows = of_attempts(session, raw_root, entity, new)
        # Rows lie in the folder of this copy; the log, written last in one file, makes them visible.
        copied = uuid.uuid4().hex
        rows.drop("attempt").write.parquet(f"{target_dir}/rows/copied={copied}")
        note_copied(target_dir, new, copied)

    writer = _new_commits(spark, raw_root, commits_per_batch).writeStream.foreachBatch(copy)
    writer = writer.option("checkpointLocation", checkpoint_dir)
    if continuous:
        writer = writer.trigger(processingTime=f"{max(1, lag_seconds // CHECKS_PER_LAG)} seconds")
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_promoted(spark: SparkSession, target_dir: str, entity: str) -> DataFrame:
    """The rows of a promoted table."""
    if not exists(spark, f"{target_dir}/log"):
        return spark.createDataFrame([], raw_schema(entity))
    copies = copy_log(spark, target_dir).select("copied").distinct()
    rows = spark.read.schema(raw_schema(entity).add("copied", "string")).parquet(f"{target_dir}/rows")
    return rows.join(copies, "copied", "left_semi").select(*raw_names(entity))


def promote_by_key(
    spark: SparkSession,
    raw_root: str,
    entity: str,
    table_root: str,
    checkpoint_dir: str,
    keys: list[str],
    newest: str,
    commits_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """P5: merge what is newly committed into a keyed table, one new version per batch.

    The table lies in buckets by key. A batch reads and writes only the buckets its keys fall
    into; the others are taken over from the version before. A version lists the attempts merged
    so far. A batch merges only attempts that the version before does not list, so a repeated
    batch and a new checkpoint folder change nothing.
    """
    schema = raw_schema(entity)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        new = batch.select("attempt").distinct()
        before = table_version(session, table_root)
        if before is not None:
            merged = read_version(session, f"{table_root}/merged", before)
            new = new.join(merged, "attempt", "left_anti")
        if new.isEmpty():
            return
        number = bucket_count(session, table_root, buckets)
        in_bucket = bucket_of(keys, number)
        changes = read_attempts(session, raw_root, entity, new)
        # A number per bucket at most.
        touched = [r["bucket"] for r in changes.select(in_bucket.alias("bucket")).distinct().collect()]
        target = read_buckets(session, table_root, schema, touched, before)
        version = max(new_version(session, table_root), next_version(session, f"{table_root}/merged"))
        rows = upsert(target, changes, keys, newest).withColumn("bucket", in_bucket)
        found = replace_buckets(rows, table_root, touched, version)
        every = new if before is None else merged.unionByName(new)
        write_version(every.coalesce(1), f"{table_root}/merged", version)
        complete(session, table_root, found, version)

    stream = _new_commits(spark, raw_root, commits_per_batch)
    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True).start()
    )


def read_keyed(spark: SparkSession, table_root: str, schema: StructType) -> DataFrame:
    """The newest version of a keyed table."""
    return read_buckets(spark, table_root, schema)
