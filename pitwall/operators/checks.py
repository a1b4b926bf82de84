"""Data checks (D1-D5). Each report has the columns (table_name, column_name, check_name, failures)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_report(counts: DataFrame, table: str, check: str, columns: list[str]) -> DataFrame:
    """Turn one row of counts into one row per column."""
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("failures")) for c in columns]
    return counts.select(F.explode(F.array(*entries)).alias("entry")).select(
        F.lit(table).alias("table_name"), "entry.column_name", F.lit(check).alias("check_name"), "entry.failures"
    )


def not_null_report(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows with NULL per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _as_report(counts, table, "not_null", columns)


def unique_report(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once; NULLs are not compared."""
    repeated = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("uses"))
        .filter(F.col("uses") > 1)
    )
    return _as_report(repeated.agg(F.count(F.lit(1)).alias(column)), table, "unique", [column])


def required_fields_report(json_lines: DataFrame, table: str, fields: list[str]) -> DataFrame:
    """Records in which a field is absent; a field with a null value is present."""
    names = F.json_object_keys("value")
    counts = json_lines.select(names.alias("names")).agg(
        *[F.count_if(~F.coalesce(F.array_contains("names", f), F.lit(False))).alias(f) for f in fields]
    )
    return _as_report(counts, table, "required", fields)


def all_reports(reports: list[DataFrame]) -> DataFrame:
    """Several reports in one."""
    return reduce(DataFrame.unionByName, reports)
