"""Token-ID output: flat files of unsigned integer ids with 64-bit document offsets.

A shard holds consecutive documents in ascending order of doc_id (nulls first, equal ids
in order of their text): ``.bin`` has their ids one after the other, in 16 bits each if the
vocabulary has no more than 65,536 ids and else in 32, ``.idx`` the place of each document's first id and of the end, as 64-bit integers, ``.doc`` the document ids.
Shards follow each other in the order of their numbers, so the place of a document in
the whole is its place in the shard plus the sizes of the shards before: one prefix sum
over one row per shard. A reader maps the files into memory and touches what it needs.

A null or empty text has the end id only. Other columns of the input are ignored. An empty
table gives no shards and no rows.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.encoding import Encoder
from pitwall.llm.tables import release_memory, stored
from pitwall.llm.taskfiles import attempt_path, mapped, opened_for_writing
from pitwall.storage import scratch_folder

_SHARD = pa.schema(
    [
        ("shard", pa.int64()), ("path", pa.string()), ("id_bytes", pa.int32()), ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)
_ENTRY = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)
ROWS_OUT = 4096
#: Parts of texts that a worker remembers with their ids, also between tasks, in each of two generations.
REMEMBERED = 600_000


def write_tokens(documents: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Encodes (doc_id, text) into shards below folder; a row per shard with its base, the ids before it."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, "kept", REMEMBERED)
        id_bytes = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 2**16 else 4
        end = end_id.to_bytes(id_bytes, "little")
        path, out, offsets, docs = "", None, [0], []
        for batch in batches:
            if out is None and batch.num_rows:
                path = attempt_path(folder, "")
                out = opened_for_writing(path + ".bin")
            docs.append(batch.column(0))
            for text in batch.column(1):
                ids = encoder.encode(text.as_py())
                out.write(np.frombuffer(ids, "<u4").astype(f"<u{id_bytes}").tobytes() + end)
                offsets.append(offsets[-1] + len(ids) // 4 + 1)
        release_memory()
        if out is None:
            return
        out.close()
        with opened_for_writing(path + ".idx") as index:
            index.write(np.array(offsets, np.int64).tobytes())
        ids = pa.chunked_array(docs, pa.int64())
        with opened_for_writing(path + ".doc") as named:
            named.write(ids.fill_null(0).to_numpy().tobytes())
            named.write(ids.is_valid().to_numpy().astype(np.int64).tobytes())
        row = [TaskContext.get().partitionId(), path, id_bytes, len(offsets) - 1, offsets[-1]]
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _SHARD)], schema=_SHARD)

    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    )
    ddl = "shard long, path string, id_bytes int, n_docs long, n_tokens long"
    shards = stored(ordered.mapInArrow(write, ddl), "shards")
    # One row per shard, so one task may sum them up.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(shards: DataFrame) -> DataFrame:
    """Of each document, from the files: doc_id, start, n_tokens and the checksum of its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                yield from _entries(shard["path"], shard["id_bytes"], shard["base"])

    n_shards = max(1, shards.count())
    return shards.select("path", "id_bytes", "base").repartition(n_shards).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _entries(path: str, id_bytes: int, base: int) -> Iterator[pa.RecordBatch]:
    ids, offsets = mapped(path + ".bin", f"<u{id_bytes}"), mapped(path + ".idx", np.int64)
    docs, valid = mapped(path + ".doc", np.int64).reshape(2, -1)
    for at in range(0, len(docs), ROWS_OUT):
        places = offsets[at : at + ROWS_OUT + 1]
        sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(places[:-1], places[1:])]
        some = slice(at, at + ROWS_OUT)
        columns = [
            pa.array(docs[some], mask=valid[some] == 0),
            pa.array(places[:-1] + base), pa.array(np.diff(places)), pa.array(sums, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_ENTRY)


def token_files(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the documents' tokens to the shared folder and reads them back; a row per document."""
    folder = scratch_folder(documents.sparkSession, "tokens")
    return read_tokens(write_tokens(documents, tokenizer, end_id, folder))
