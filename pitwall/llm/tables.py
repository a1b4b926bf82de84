"""Shared plumbing of the operators: given tables, intermediate tables, task folders."""

import ctypes
import ctypes.util
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.words import forget_powers
from pitwall.storage import scratch_folder


#: Bytes of rows that go to Python at a time.
BATCH_BYTES, BATCH_SETTING = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the memory that a batch of long texts takes in a task and its Python worker."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def release_memory() -> None:
    """Give back memory at the end of a task: Spark keeps Python workers for later tasks, of whatever query."""
    forget_powers()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim:
        trim(0)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Drop the shuffle files of a query when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder; cuts the lineage, survives lost executors.

    Once the table is written nothing needs the shuffles behind it, so their files go.
    """
    spark = df.sparkSession
    small_batches(spark)
    path, before = scratch_folder(spark, label), spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def checksum32(key: str) -> F.Column:
    """Unsigned CRC-32 of a column's text."""
    return F.crc32(F.col(key).cast("string").cast("binary"))


def by_batch(
    make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function: make() once per task (models, tokenizers), then its result once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or make()
            if batch.num_rows:
                yield from work(batch)
        del work
        release_memory()

    return run


def in_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Rows sorted by their first n_keys columns, group by group."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None or not len(held) else pa.concat_tables([held, table])
        held = held.combine_chunks()
        keys = np.stack([held.column(k).to_numpy() for k in range(n_keys)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts):
            yield held.slice(a, b - a)
        held = held.slice(cuts[-1] if len(cuts) else 0)
    if held is not None and len(held):
        yield held
