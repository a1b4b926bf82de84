"""Difference of two tables as multisets: rows by digest, copies by count."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(columns: list[str]) -> Column:
    """128 bits of SHA-256 over all columns of a row, as text. NULL differs from any value."""
    row = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    return F.substring(F.sha2(row, 256), 1, 32)


def changed_rows(before: DataFrame, after: DataFrame, *keep: str) -> DataFrame:
    """Digests whose copies differ, and by how many (``more``, negative for fewer).

    Both sides have digest and copies, and the columns ``keep``, which a digest decides on. Only
    these are shuffled, summed up before.
    """
    both = before.select("digest", (-F.col("copies")).alias("more"), *keep).unionByName(
        after.select("digest", F.col("copies").cast("long").alias("more"), *keep)
    )
    return both.groupBy("digest", *keep).agg(F.sum("more").alias("more")).filter(F.col("more") != 0)
