"""Row numbers within groups of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.conditions import smallest_first


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str, cut: Column) -> DataFrame:
    """Add ``name`` = 1, 2, ... within each group of ``keys``, ascending by ``order``, NULL last.

    Rows equal on ``order`` are told apart by all their other columns, so the
    numbers are the same on every run.

    ``cut`` slices every group: a whole number that never falls while ``order[0]``
    rises, NULL if that is NULL. Each slice is numbered for itself and shifted by the
    rows of the slices before it, which an aggregate counts; so no task gets more than
    one slice of a group, whatever the group's size. Rows that share keys and slice are
    sorted by one task, which may spill. Nothing runs before the result is asked for,
    and no value is changed.
    """
    total_order = order + [c for c in df.columns if c not in keys and c not in order]
    # A struct takes part in joins and windows with its NULLs.
    sliced = df.withColumn("__place", F.struct(*keys, F.coalesce(cut.cast("bigint"), F.lit(2**63 - 1)).alias("slice")))
    within = Window.partitionBy("__place").orderBy(*[smallest_first(F.col(c)) for c in total_order])
    numbered = sliced.withColumn("__number", F.row_number().over(within))

    counts = sliced.groupBy("__place").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = (
        Window.partitionBy(*[F.col(f"__place.{k}") for k in keys]).orderBy("__place.slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("__place", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    return (
        numbered.join(starts, "__place").withColumn(name, (F.col("__start") + F.col("__number")).cast("bigint"))
        .drop("__place", "__start", "__number")
    )
