"""Checks of the raw and staged tables kept as state (D1-D4): mergeable counts per attempt to load.

Nulls per column add up over attempts, and so do the uses of a key. Every attempt is looked
through once, only in the columns that are checked; a check run after that reads counts and no
raw rows. A withdrawn attempt drops out with its counts.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.plans import staging
from pitwall.schemas import ENTITIES, NOT_NULL_RAW, NOT_NULL_STAGING
from pitwall.sources.tables import attempts_now, of_attempts
from pitwall.storage import checkpointed, exists

COUNTS = "attempt string, table_name string, column_name string, check_name string, key bigint, uses bigint"
#: The column whose values must be unique, and the tables in which.
UNIQUE_KEY, UNIQUE_IN = "session_key", ("sessions", "stg_sessions")
#: The staged table of each raw one, by the filter that its rows pass. What staging does beyond that drops no NULL.
STAGED = {
    "sessions": ("stg_sessions", staging.stg_sessions), "drivers": ("stg_drivers", staging.known_drivers),
    "laps": ("stg_laps", staging.stg_laps), "positions": ("stg_positions", staging.stg_positions),
}


def declared_checks() -> list[tuple[str, str, str]]:
    """(table, column, check) of all checks."""
    not_null = [(t, c, "not_null") for of in (NOT_NULL_RAW, NOT_NULL_STAGING) for t, columns in of.items() for c in columns]
    return not_null + [(t, UNIQUE_KEY, "unique") for t in UNIQUE_IN]


def _null_counts(rows: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows with NULL per attempt and column, all columns in one pass."""
    counts = rows.groupBy("attempt").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("uses")) for c in columns]))
    return _counts(counts.select("attempt", entries.alias("e")), table, F.col("e.column_name"), "not_null", F.col("e.uses"))


def _key_counts(rows: DataFrame, table: str) -> DataFrame:
    """Uses of a key per attempt."""
    known = rows.filter(F.col(UNIQUE_KEY).isNotNull()).groupBy("attempt", UNIQUE_KEY).agg(F.count(F.lit(1)).alias("uses"))
    return _counts(known, table, F.lit(UNIQUE_KEY), "unique", F.col("uses"), F.col(UNIQUE_KEY))


def _counts(
    rows: DataFrame, table: str, column: Column, check: str, uses: Column, key: Column | None = None
) -> DataFrame:
    key = F.lit(None).cast("bigint") if key is None else key
    return rows.select(
        "attempt", F.lit(table).alias("table_name"), column.alias("column_name"), F.lit(check).alias("check_name"),
        key.alias("key"), uses.alias("uses"),
    )


def check_counts(spark: SparkSession, raw_root: str) -> DataFrame:
    """The counts of all attempts that count now; those of new attempts are taken and kept."""
    path, attempts = f"{raw_root}/checks", checkpointed(attempts_now(spark, raw_root))
    kept = spark.read.schema(COUNTS).parquet(path) if exists(spark, path) else spark.createDataFrame([], COUNTS)
    new = checkpointed(attempts.join(kept.select("attempt"), "attempt", "left_anti"))
    if not new.isEmpty():
        taken = [new.select("attempt", *[F.lit(None).cast(kind).alias(n) for n, kind in _rest()])]
        for entity in ENTITIES:
            rows = of_attempts(spark, raw_root, entity, new)
            staged_name, staged = STAGED[entity]
            # Staging selects its own columns; the attempt travels in one that it passes on and that is not checked.
            carried = rows.drop("ingested_at").withColumnRenamed("attempt", "ingested_at")
            valid = staged(carried).withColumnRenamed("ingested_at", "attempt")
            taken += [_null_counts(rows, entity, NOT_NULL_RAW[entity]), _null_counts(valid, staged_name, NOT_NULL_STAGING[staged_name])]
            if entity == "sessions":
                taken += [_key_counts(rows, entity), _key_counts(valid, staged_name)]
        reduce(DataFrame.unionByName, taken).hint("rebalance").write.mode("append").parquet(path)
    if not exists(spark, path):
        return kept
    return spark.read.schema(COUNTS).parquet(path).join(attempts, "attempt", "left_semi")


def _rest() -> list[tuple[str, str]]:
    return [tuple(column.split()) for column in COUNTS.split(", ")[1:]]


def checks_from_state(spark: SparkSession, raw_root: str) -> DataFrame:
    """The report of all checks, from kept counts; a check passes with zero failures."""
    counts = check_counts(spark, raw_root).filter(F.col("table_name").isNotNull())
    names = ["table_name", "column_name", "check_name"]
    per_key = counts.groupBy(*names, "key").agg(F.sum("uses").alias("uses"))
    failures = F.when(F.col("check_name") == "not_null", F.col("uses")).otherwise((F.col("uses") > 1).cast("bigint"))
    found = per_key.groupBy(*names).agg(F.sum(failures).alias("failures"))
    declared = spark.createDataFrame(declared_checks(), ", ".join(f"{n} string" for n in names))
    return declared.join(found, names, "left").select(*names, F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"))
