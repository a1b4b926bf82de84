"""Connected components of a graph given as an edge table."""

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import stored


#: Edges that one task reduces to a forest in memory.
TASK_EDGES = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a task's edges: each node that is not the least of its tree, with the least."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in parent]
    columns = list(zip(*[p for p in pairs if p[0] != p[1]])) or [(), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Joins neighbours of each node to the least node around it: the larger ones, or all others."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    around = both.join(least, "a")
    moved = around.where(F.col("b") > F.col("a")) if large else around
    pairs = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        pairs = pairs.unionByName(least.select("a", F.col("m").alias("b")))
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its least node.

    edges: (a, b), longs, in any direction, repeated or not. Each task first reduces a bounded
    number of edges to a forest by union-find; if that took one task, it is the result. Else
    large and small stars alternate until the edges no longer change; every node is then joined
    to the least one of its component. Each step is a distributed join on nodes; only counts
    and a checksum come to the driver.
    """
    loose = stored(
        edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b"), "edges"
    )
    tasks = max(1, math.ceil(loose.count() / TASK_EDGES))
    current = stored(loose.coalesce(tasks).mapInArrow(_forest, "a long, b long"), "edges")
    seen = _fingerprint(current) if tasks > 1 else (0,)
    while seen[0]:
        current = stored(_star(_star(current, large=True), large=False), "edges")
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
