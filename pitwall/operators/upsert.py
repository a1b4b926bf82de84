"""Keyed upsert (P5)."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.latest import latest_per_key


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """Target rows whose key has a change take its values; changes with a new key are added.

    Only the newest change of a key counts. A key that occurs in several target
    rows has all of them updated. Both sides are read once. The result is a new
    DataFrame; the caller writes it beside the old one, never over it.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    change = latest_per_key(changes.select(*columns), keys, newest, rest).select(
        *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("is_change")
    )
    same_key = reduce(Column.__and__, [F.col(k) == F.col(f"new_{k}") for k in keys])
    return target.join(change, same_key, "full").select(
        *[F.when(F.col("is_change"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
