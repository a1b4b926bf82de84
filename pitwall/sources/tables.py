"""Raw tables as stored: a folder per entity, a sub-folder per attempt to load, and a log of commits.

An attempt writes to folders of its own and is visible once its row is in the log, until it is
withdrawn by a row in a second log. What the log names is never written again. Readers of whole
tables join the rows with the log; readers of some attempts open the folders of these and no others.
"""

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitwall.plans.layers import RawTables
from pitwall.schemas import ENTITIES, raw_names, raw_schema
from pitwall.storage import checkpointed, exists

COMMITS = "load_id string, attempt string, committed_at timestamp"


def withdrawals_path(raw_root: str) -> str:
    return f"{raw_root}/withdrawals"


def commits(spark: SparkSession, raw_root: str) -> DataFrame:
    """The log: a row per committed attempt that has not been withdrawn."""
    path = f"{raw_root}/commits"
    if not exists(spark, path):
        return spark.createDataFrame([], COMMITS)
    log = spark.read.schema(COMMITS).parquet(path)
    if not exists(spark, withdrawals_path(raw_root)):
        return log
    return log.join(spark.read.schema("attempt string").parquet(withdrawals_path(raw_root)), "attempt", "left_anti")


def attempts_now(spark: SparkSession, raw_root: str) -> DataFrame:
    """The attempts that count."""
    return commits(spark, raw_root).select("attempt").distinct()


def with_attempt(spark: SparkSession, raw_root: str, entity: str) -> DataFrame:
    """Rows of all attempts, committed or not, and the attempt of each."""
    schema = raw_schema(entity).add("attempt", T.StringType())
    path = f"{raw_root}/{entity}"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def of_attempts(spark: SparkSession, raw_root: str, entity: str, attempts: DataFrame) -> DataFrame:
    """Rows of some attempts and the attempt of each. Only the folders of these are listed and opened.

    The names of the attempts, a short text per load, go to the driver.
    """
    schema, root = raw_schema(entity).add("attempt", T.StringType()), f"{raw_root}/{entity}"
    names = sorted({r["attempt"] for r in attempts.select("attempt").collect()})
    folders = [f"{root}/attempt={name}" for name in names if exists(spark, f"{root}/attempt={name}")]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def read_attempts(spark: SparkSession, raw_root: str, entity: str, attempts: DataFrame) -> DataFrame:
    """Rows of some attempts."""
    return of_attempts(spark, raw_root, entity, attempts).select(*raw_names(entity))


def read_raw(spark: SparkSession, raw_root: str, entity: str) -> DataFrame:
    """Rows of all committed attempts of a raw table."""
    done = attempts_now(spark, raw_root)
    return with_attempt(spark, raw_root, entity).join(done, "attempt", "left_semi").select(*raw_names(entity))


def read_raw_tables(spark: SparkSession, raw_root: str) -> RawTables:
    return RawTables(**{entity: partial(read_raw, spark, raw_root, entity) for entity in ENTITIES})


KEYS = "session_key bigint, attempt string"


def session_keys(spark: SparkSession, raw_root: str, attempts: DataFrame) -> DataFrame:
    """The sessions of which attempts hold rows: session_key, attempt. Only these two columns are read, once per attempt.

    What is found is kept beside the raw tables. An attempt never changes, so it is looked through once.
    """
    path = f"{raw_root}/keys"
    kept = spark.read.schema(KEYS).parquet(path) if exists(spark, path) else spark.createDataFrame([], KEYS)
    new = checkpointed(attempts.select("attempt").distinct().join(kept.select("attempt"), "attempt", "left_anti"))
    if not new.isEmpty():
        found = [of_attempts(spark, raw_root, entity, new).select("session_key", "attempt") for entity in ENTITIES]
        rows = reduce(DataFrame.unionByName, found).distinct()
        # An attempt without rows is known by a row without a key.
        known = new.join(rows, "attempt", "left").select("session_key", "attempt")
        known.hint("rebalance").write.mode("append").parquet(path)
    return spark.read.schema(KEYS).parquet(path) if exists(spark, path) else kept
