"""Mirrors of raw tables in the next environment: what is added, changed or removed there is so here.

A mirror is a table in buckets by session. A run compares the digests and copies of all rows of
the committed attempts with those the mirror holds, and writes only the buckets in which they
differ; a run without a difference writes no rows. Equal rows are stored once, with their copies.
Digests are taken for the comparison alone and neither stored nor carried along with the rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitwall.operators.copies import fold_copies, split_chunks, unfold
from pitwall.operators.difference import changed_rows, row_digest
from pitwall.schemas import raw_names, raw_schema
from pitwall.sinks.buckets import (
    BUCKETS, bucket_count, bucket_of, complete, new_version, read_buckets, replace_buckets, table_version,
)
from pitwall.sources.tables import attempts_now, read_attempts, withdrawals_path
from pitwall.storage import checkpointed, exists, make_folder
from pitwall.streaming.lag import CHECKS_PER_LAG, TARGET_LAG_SECONDS, note_copied

#: What sessions a row belongs to decides on its bucket.
BY = ["session_key"]


def _mirror_schema(entity: str) -> T.StructType:
    return T.StructType([*raw_schema(entity), T.StructField("copies", T.LongType())])


def _digested(rows: DataFrame, names: list[str], place: Column, copies: Column) -> DataFrame:
    """What the comparison needs of a row: 128 bits, its bucket and copies."""
    return rows.select(F.unhex(row_digest(names)).alias("digest"), place.alias("bucket"), copies.alias("copies"))


def _changes(source: DataFrame, there: DataFrame | None, names: list[str], place: Column) -> DataFrame:
    """Rows added and removed per bucket that differs; without a mirror so far, all are added."""
    if there is None:
        added = source.groupBy(place.alias("bucket")).agg(F.count(F.lit(1)).alias("added"))
        return added.withColumn("removed", F.lit(0).cast("long"))
    before, after = (_digested(df, names, place, n) for df, n in ((there, F.col("copies")), (source, F.lit(1))))
    return changed_rows(before, after, "bucket").groupBy("bucket").agg(
        F.sum(F.greatest("more", F.lit(0))).alias("added"), F.sum(F.greatest(-F.col("more"), F.lit(0))).alias("removed")
    )


def mirror(spark: SparkSession, raw_root: str, entity: str, target: str, buckets: int = BUCKETS) -> dict[str, int]:
    """Bring the mirror to what is committed now; return the rows added and removed and the buckets written."""
    number, schema = bucket_count(spark, target, buckets), _mirror_schema(entity)
    # One list of attempts for both passes.
    attempts = checkpointed(attempts_now(spark, raw_root))
    names, place = raw_names(entity), bucket_of(BY, number)
    source = read_attempts(spark, raw_root, entity, attempts)
    # Folding takes -0.0 for 0.0, and so must the digest.
    source = source.withColumns({n: F.col(n) + F.lit(0.0) for n, kind in source.dtypes if kind == "double"})
    held = table_version(spark, target)
    there = None if held is None else read_buckets(spark, target, schema, version=held)
    changes = _changes(source, there, names, place)
    # A row per bucket at most.
    found = changes.collect()
    if found:
        touched, version = [r["bucket"] for r in found], new_version(spark, target)
        rows = fold_copies(source.withColumn("bucket", place).filter(F.col("bucket").isin(touched)), [*names, "bucket"])
        complete(spark, target, replace_buckets(rows, target, touched, version), version)
    note_copied(target, attempts)
    return {
        "added": sum(r["added"] for r in found), "removed": sum(r["removed"] for r in found), "buckets": len(found),
    }


def read_mirror(spark: SparkSession, target: str, entity: str) -> DataFrame:
    """The rows of a mirror, copies and all."""
    return unfold(split_chunks(read_buckets(spark, target, _mirror_schema(entity))), "place").select(*raw_names(entity))


def keep_mirrored(
    spark: SparkSession, raw_root: str, entity: str, target: str, checkpoint_dir: str, continuous: bool = False,
    lag_seconds: int = TARGET_LAG_SECONDS,
) -> StreamingQuery:
    """Mirror whenever attempts have been committed or withdrawn; once, or on within the target lag."""

    def run(batch: DataFrame, batch_id: int) -> None:
        mirror(batch.sparkSession, raw_root, entity, target)

    for folder in (f"{raw_root}/commits", withdrawals_path(raw_root)):
        if not exists(spark, folder):
            make_folder(spark, folder)
    logs = [
        spark.readStream.schema("attempt string").parquet(folder)
        for folder in (f"{raw_root}/commits", withdrawals_path(raw_root))
    ]
    writer = logs[0].unionByName(logs[1]).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_dir)
    if continuous:
        writer = writer.trigger(processingTime=f"{max(1, lag_seconds // CHECKS_PER_LAG)} seconds")
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()
