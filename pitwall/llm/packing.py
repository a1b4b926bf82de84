"""Packing documents into sequences of at most C tokens, by bound-certified repacking.

Documents become pieces: only those longer than C are cut. Pieces are dealt at random into
partitions of bounded size; each is packed by best-fit decreasing. Dual feasible functions
give every partition a lower bound for its number of bins. A partition that meets its bound
is certified and keeps all bins but its emptiest one; a partition with a gap keeps its full
bins. Either keeps, if these hold less than half of its pieces, its fullest ones up to half. The
pieces of the bins not kept go to new partitions with those of the others, and are packed again,
until the pool is one partition. It shrinks to half in every round.

A null or empty text has the end id only and is packed like any other. Rows with equal
doc_id (also null) are packed each on its own. Other columns of the input are ignored. An
empty table gives no rows.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.encoding import Encoder
from pitwall.llm.tables import release_memory, small_batches, stored

#: Pieces packed in one task.
PARTITION_PIECES = 60_000
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_NUMBERED = pa.schema([*_PIECE, ("number", pa.int64())])
_PLACED = pa.schema(
    [*_NUMBERED, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("kept", pa.bool_()), ("bound", pa.int64())]
)
_PLACED_DDL = f"{_PIECE_DDL}, number long, sequence_id long, offset long, kept boolean, bound long"


def cut_into_pieces(documents: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, checksum of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(tokenizer, "dropped"), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE
                )
        encoder.rest()
        release_memory()

    small_batches(documents.sparkSession)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(cut, _PIECE_DDL)


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """The best lower bound that two families of dual feasible functions give.

    With threshold t <= C/2, lengths over C - t count as C and lengths under t as nothing.
    With integer k, a length x counts as x if (k + 1) x / C is whole, else as its floor times C / k.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    n, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    t = np.arange(1, capacity // 2 + 1)
    large = n[-1] - n[capacity - t]
    middle = total[capacity - t] - total[t - 1]
    best = max(-(-int(total[-1]) // capacity), int((large - (-middle // capacity)).max(initial=0)))
    x = np.arange(capacity + 1)
    for k in range(1, 21):
        # In units of C * k, so that all values are whole.
        value = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the free room of each bin."""
    bins, offsets, free = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if an open bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        free[b] = left = room - length
        if left:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def _packed(capacity: int, first_id: int, group_step: int):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("number", "ascending")])
        lengths = table["length"].to_numpy()
        bins, offsets, free = best_fit_decreasing(lengths, capacity)
        bound = least_bins(lengths, capacity)
        kept = free == 0
        if len(free) == bound:
            kept = np.ones(len(free), bool)
            kept[free.argmax()] = free.max() == 0
        held, fullest = np.bincount(bins, minlength=len(free)), np.argsort(free, kind="stable")
        kept[fullest[2 * (np.cumsum(held[fullest]) - held[fullest]) < len(bins)]] = True
        placed = [*(table[name] for name in _NUMBERED.names), pa.array(first_id + key[0].as_py() * group_step + bins)]
        placed += [pa.array(offsets), pa.array(kept[bins]), pa.array(np.full(len(bins), bound))]
        return pa.Table.from_arrays(placed, schema=_PLACED)

    return pack


def pack_pieces(pieces: DataFrame, capacity: int, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """Adds sequence_id and offset to each piece."""
    done: list[DataFrame] = []
    # Equal rows are dealt apart by their numbers.
    pool = stored(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    n = pool.count()
    first_id, round_no = 0, 0
    while True:
        groups = max(1, math.ceil(n / partition_pieces))
        deal = F.pmod(F.xxhash64("number", F.lit(round_no)), F.lit(groups))
        dealt = pool.withColumn("part", deal)
        largest = dealt.groupBy("part").count().agg(F.max("count")).first()[0] or 0
        placed = stored(
            dealt.groupBy("part").applyInArrow(_packed(capacity, first_id, largest), _PLACED_DDL), "packed",
        )
        if groups == 1:
            return _together([*done, placed])
        done.append(placed.where("kept"))
        pool = placed.where("not kept").select(*_NUMBERED.names)
        n = pool.count()
        first_id += groups * largest
        round_no += 1


def _together(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(*_PIECE.names, "sequence_id", "offset")


def packed_sequences(documents: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack_pieces(cut_into_pieces(documents, tokenizer, end_id, capacity), capacity)
