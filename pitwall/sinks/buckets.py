"""Tables in buckets: a version lists a folder per bucket, and takes over those that did not change.

A version is complete once its manifest is written, which is the last thing a writer does.
Folders are never changed after that, so readers of older versions are not disturbed.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitwall.storage import (
    current_version, delete_folder, finished_folders, folder_names, make_folder, next_version, read_version, write_version,
)

# Buckets of a table that is told no other number: some terabytes.
BUCKETS = 16
MANIFEST = "bucket int, version bigint"


def bucket_count(spark: SparkSession, root: str, wanted: int = BUCKETS) -> int:
    """The number of buckets a table has; a new one is told the wanted number, which then stays."""
    kept = folder_names(spark, f"{root}/layout", "buckets=")
    if not kept:
        make_folder(spark, f"{root}/layout/buckets={wanted}")
    return int(kept[0]) if kept else wanted


def bucket_of(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def table_version(spark: SparkSession, root: str) -> int | None:
    """The newest complete version."""
    return current_version(spark, f"{root}/manifest")


def manifest(spark: SparkSession, root: str, version: int | None) -> dict[int, int]:
    """The version in which each bucket that has rows was written."""
    if version is None:
        return {}
    return {r["bucket"]: r["version"] for r in read_version(spark, f"{root}/manifest", version).collect()}


def read_buckets(
    spark: SparkSession, root: str, schema: StructType, only: list[int] | None = None, version: int | None = None
) -> DataFrame:
    """The rows of a version, by default the newest, or those of some of its buckets."""
    version = table_version(spark, root) if version is None else version
    found = manifest(spark, root, version)
    paths = [_folder(root, v, b) for b, v in sorted(found.items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _folder(root: str, version: int, bucket: int) -> str:
    return f"{root}/rows/v={version:012d}/bucket={bucket}"


def new_version(spark: SparkSession, root: str) -> int:
    """A number above all versions, complete or not."""
    return max(next_version(spark, f"{root}/{part}") for part in ("rows", "manifest"))


def replace_buckets(
    rows: DataFrame, root: str, touched: list[int], version: int, sort_by: list[str] | None = None
) -> dict[int, int]:
    """Write ``rows``, all rows of the touched buckets (column ``bucket``), as a version; return its manifest.

    The version is not complete before ``complete`` is called. A bucket without rows goes. Rows may be
    sorted within each file.
    """
    spark, before = rows.sparkSession, manifest(rows.sparkSession, root, table_version(rows.sparkSession, root))
    path = f"{root}/rows/v={version:012d}"
    rows = rows.hint("rebalance", "bucket")
    if sort_by:
        rows = rows.sortWithinPartitions("bucket", *sort_by)
    rows.write.mode("error").partitionBy("bucket").parquet(path)
    written = {int(b): version for b in folder_names(spark, path, "bucket=")}
    return {b: v for b, v in before.items() if b not in touched} | written


def complete(spark: SparkSession, root: str, found: dict[int, int], version: int) -> None:
    """Make a version the newest one."""
    write_version(spark.createDataFrame(sorted(found.items()), MANIFEST).coalesce(1), f"{root}/manifest", version)


def drop_unused_buckets(spark: SparkSession, root: str, keep: int) -> None:
    """Remove manifests but the newest so many, and folders that none of these names."""
    versions = [int(v) for v in finished_folders(spark, f"{root}/manifest", "v=")]
    kept = versions[-keep:]
    used = {(v, b) for version in kept for b, v in manifest(spark, root, version).items()}
    for version in versions[:-keep]:
        delete_folder(spark, f"{root}/manifest/v={version:012d}")
    for v in folder_names(spark, f"{root}/rows", "v="):
        if int(v) > kept[-1]:
            continue
        for b in folder_names(spark, f"{root}/rows/v={v}", "bucket="):
            if (int(v), int(b)) not in used:
                delete_folder(spark, f"{root}/rows/v={v}/bucket={b}")
