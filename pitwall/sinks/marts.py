"""Publishing marts as tables (M2)."""

from pyspark.sql import DataFrame, SparkSession

from pitwall.sinks import buckets
from pitwall.storage import current_version, drop_old_versions, next_version, read_version, write_version

MARTS = ("dim_drivers", "fct_lap_times", "fct_race_results")


def schema_name(target: str, custom: str | None = None) -> str:
    """The target's own schema, or the custom one in upper case."""
    return target if custom is None else custom.strip().upper()


def table_layout(name: str, df: DataFrame) -> DataFrame:
    """Rows in the order a table is stored in.

    Race results lie by session and position. Lap times are only sorted by driver
    within each file, which costs no shuffle and lets the reports on one driver
    skip most of every file.
    """
    if name == "fct_race_results":
        order = ["session_key", "final_position"]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    if name == "fct_lap_times":
        return df.sortWithinPartitions("driver_number")
    return df


def publish(df: DataFrame, marts_root: str, name: str, keep: int | None = None) -> int:
    """Rebuild a mart in full as a new version; readers move on once it is complete.

    Two builders at a time write versions of their own, or one of them fails before it has
    written anything. With ``keep``, older versions but so many are removed.
    """
    root, spark = f"{marts_root}/{name}", df.sparkSession
    version = max(next_version(spark, root), buckets.new_version(spark, root))
    write_version(table_layout(name, df), root, version)
    if keep:
        drop_old_versions(spark, root, keep)
    return version


def read_mart(spark: SparkSession, marts_root: str, name: str) -> DataFrame:
    """The newest complete version of a mart."""
    root = f"{marts_root}/{name}"
    version, in_buckets = current_version(spark, root), buckets.table_version(spark, root)
    if version is None and in_buckets is None:
        raise ValueError(f"{name} has not been published yet")
    if in_buckets is not None and in_buckets > (version or 0):
        columns = spark.read.schema("ddl string").json(f"{root}/columns").first()["ddl"]
        return buckets.read_buckets(spark, root, spark.createDataFrame([], columns).schema, version=in_buckets)
    return read_version(spark, root, version)


#: Facts whose rows depend on one session only, and what their files are sorted by.
SESSION_FACTS = {"fct_lap_times": ["driver_number"], "fct_race_results": ["session_key", "final_position"]}


def replace_sessions(rows: DataFrame, sessions: DataFrame, marts_root: str, name: str) -> int:
    """A new version of a fact in which some sessions have the given rows, and all others those they had.

    The fact lies in buckets by session. Only buckets of these sessions are read and written; the
    others are taken over. Returns the number of buckets written. A fact that was published whole
    is taken over once, whole.
    """
    spark, root = rows.sparkSession, f"{marts_root}/{name}"
    number, version = buckets.bucket_count(spark, root), current_version(spark, root)
    before = buckets.table_version(spark, root)
    place = buckets.bucket_of(["session_key"], number)
    if version is not None and version > (before or 0):
        kept, touched = read_version(spark, root, version), list(range(number))
    else:
        # A number per bucket at most.
        touched = [r["bucket"] for r in sessions.select(place.alias("bucket")).distinct().collect()]
        kept = buckets.read_buckets(spark, root, rows.schema, touched, before)
    every = kept.join(sessions, "session_key", "left_anti").unionByName(rows).withColumn("bucket", place)
    new = max(buckets.new_version(spark, root), next_version(spark, root))
    found = buckets.replace_buckets(every, root, touched, new, SESSION_FACTS[name])
    if before is None:
        ddl = ", ".join(f"{column} {kind}" for column, kind in rows.dtypes)
        spark.createDataFrame([(ddl,)], "ddl string").coalesce(1).write.mode("ignore").json(f"{root}/columns")
    buckets.complete(spark, root, found, new)
    return len(touched)


def register_marts(spark: SparkSession, marts_root: str, schema: str | None = None) -> None:
    """Make the newest versions readable by table name in the session, in a schema's name if one is given."""
    prefix = "" if schema is None else f"{schema_name(schema)}_"
    for name in MARTS:
        read_mart(spark, marts_root, name).createOrReplaceTempView(f"{prefix}{name}")
