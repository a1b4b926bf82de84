"""Equal rows carried as one row and a count, and unfolded again."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that one folded row may unfold into within a task.
CHUNK_ROWS = 100_000


def fold_copies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns`` with ``copies``, counted before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def split_chunks(folded: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Replace ``copies`` by rows (``chunk_start``, ``chunk_size``) of at most ``chunk_rows`` copies.

    A shuffle after this can spread the chunks over tasks, so that even one row
    with billions of copies is unfolded by many tasks.
    """
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(chunk_rows).cast("bigint"))
    return (
        folded.withColumn("chunk_start", F.explode(starts))
        .withColumn("chunk_size", F.least(F.lit(chunk_rows).cast("bigint"), F.col("copies") - F.col("chunk_start")))
        .drop("copies")
    )


def unfold(chunks: DataFrame, place: str) -> DataFrame:
    """One row per copy, with its zero-based ``place`` among the copies of its row."""
    places = F.sequence(F.col("chunk_start"), F.col("chunk_start") + F.col("chunk_size") - 1)
    return chunks.withColumn(place, F.explode(places)).drop("chunk_start", "chunk_size")
