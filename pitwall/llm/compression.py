"""Quality by compression: a text is good if it compresses better with a dictionary of good texts.

Two zstandard dictionaries are built, from blocks of texts labelled good and of texts labelled
bad. A whole text, block by block, is compressed with each of them; the difference of the two
sizes per byte of text says which it resembles. A logistic curve, fitted on labelled texts that
no dictionary has seen, turns the difference into a calibrated score.

The labels learnt from are a bounded sample: of each label the documents with the least hash of
doc_id, and of their blocks those with the least hash. A document labelled more than once counts
as good if any row says so. Labels that are null or of documents that do not exist are not learnt
from. If no text of a label is left, every score is 0.5. A null or empty text has the difference 0
and the score of that. Rows with one doc_id, also null, are scored each. An empty table gives no
rows. Very long texts are compressed block by block, so memory does not follow their length.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.tables import by_batch, release_memory, stored
from pitwall.llm.words import text_buffer

#: Labelled documents learnt from, blocks of them for a dictionary, and documents for the curve; each per label.
SAMPLE_DOCUMENTS, SAMPLE_BLOCKS, SAMPLE_CURVE = 8_192, 12_000, 2_048
BLOCK_BYTES = 256
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: One labelled document of so many goes to the curve, the others to the dictionaries.
CURVE_PART = 3
RIDGE, STEPS = 1e-3, 50


@dataclass
class Model:
    """The dictionaries as bytes, and the curve; no dictionaries if there was nothing to learn from."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0

    def differences(self, texts: pa.Array) -> np.ndarray:
        """Size with the bad dictionary less size with the good one, per byte, of each text."""
        if not self.good:
            return np.zeros(len(texts))
        good, bad = (_compressor(d) for d in (self.good, self.bad))
        offsets, data = text_buffer(texts)
        data, found = memoryview(data), np.zeros(len(texts))
        for i in range(len(texts)):
            first, end = int(offsets[i]), int(offsets[i + 1])
            more = 0
            for at in range(first, end, BLOCK_BYTES):
                block = data[at : min(at + BLOCK_BYTES, end)]
                more += len(bad.compress(block)) - len(good.compress(block))
            found[i] = more / max(1, end - first)
        return found

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * differences + self.offset, -35, 35)))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
        write_checksum=False, write_dict_id=False,
    )


def dictionary_of(blocks: list[bytes]) -> bytes:
    """A dictionary trained on blocks; of too few to train on, the blocks themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def curve_of(differences: np.ndarray, good: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic regression, by Newton's method with a small ridge."""
    scale = float(np.std(differences)) or 1.0
    x = np.stack([differences / scale, np.ones(len(differences))], 1)
    w = np.zeros(2)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (weights * (p - good)) + RIDGE * w
        curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2)
        w -= np.clip(np.linalg.solve(curvature, gradient), -5, 5)
    return float(w[0] / scale), float(w[1])


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(good, pick, block) of (good, pick, text): every block of a text, with a hash of its own to pick it by."""
    offsets, data = text_buffer(batch.column(2))
    good, pick = batch.column(0), batch.column(1)
    for i in range(len(batch)):
        starts = np.arange(offsets[i], offsets[i + 1], BLOCK_BYTES)
        number = np.arange(len(starts), dtype=np.uint64)
        picks = (number * np.uint64(0x9E3779B97F4A7C15)) ^ np.int64(pick[i].as_py()).view(np.uint64)
        for at in range(0, len(starts), 8_192):
            part = slice(at, at + 8_192)
            blocks = [data[s : min(s + BLOCK_BYTES, offsets[i + 1])].tobytes() for s in starts[part]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([good[i].as_py()] * len(blocks), pa.int32()),
                    pa.array(picks[part].view(np.int64)), pa.array(blocks, pa.binary()),
                ],
                ["good", "pick", "block"],
            )


def _least(rows: DataFrame, most: int) -> DataFrame:
    """Of each label the rows with the least pick; every task keeps so many at most before any are moved."""
    rank = F.row_number().over(Window.partitionBy("good").orderBy("pick"))
    return rows.withColumn("place", rank).where(F.col("place") <= most).drop("place")


def trained(documents: DataFrame, labels: DataFrame, learn_from: Column, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Learns from (doc_id, quality) rows that learn_from admits."""
    known = (
        labels.where(learn_from & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled")).agg((F.max("quality") > 0).cast("int").alias("good"))
    )
    known = known.withColumn("pick", F.xxhash64("labelled", F.lit("sample")))
    # Three numbers a row and a bounded number of rows: it may be broadcast.
    sample = F.broadcast(_least(known, sample_documents))
    texts = stored(
        documents.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("labelled")).select(
            "good", F.xxhash64("pick", F.col("text").cast("string")).alias("pick"),
            (F.pmod("pick", F.lit(CURVE_PART)) == 0).alias("for_curve"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ),
        "labelled",
    )
    blocks = texts.where(~F.col("for_curve")).select("good", "pick", "text").mapInArrow(
        by_batch(lambda: _blocks), "good int, pick long, block binary"
    )
    picked = _least(blocks, SAMPLE_BLOCKS).orderBy("good", "pick", "block").toArrow()
    of_label = [[], []]
    for good, block in zip(picked["good"].to_pylist(), picked["block"].to_pylist()):
        of_label[good].append(block)
    if not all(of_label):
        return Model()
    model = Model(dictionary_of(of_label[1]), dictionary_of(of_label[0]))
    shares = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    for unseen in (True, False):
        curve = _least(texts.where(F.col("for_curve") == unseen), SAMPLE_CURVE)
        found = differing(curve, model).select("good", "difference").toArrow()
        good = found["good"].to_numpy()
        if 0 < good.sum() < len(good):
            break
    counts = np.bincount(good, minlength=2)
    weights = np.array([shares[label] / counts[label] for label in (0, 1)])[good]
    weights *= len(good) / weights.sum()
    model.slope, model.offset = curve_of(found["difference"].to_numpy(), good, weights)
    return model


def differing(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with ``difference``; only texts go to Python, and only numbers come back."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def difference(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(shared.value.differences(texts))
        release_memory()

    return documents.withColumn("difference", difference.asNondeterministic()(F.col("text").cast("string")))


def scored(documents: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The documents with ``score`` (0 to 1, higher: likelier good) and ``predicted`` (1 from the least score on)."""
    rows = documents.select(F.struct("*").alias("row"), F.col("text"))
    power = F.lit(model.slope) * F.col("difference") + F.lit(model.offset)
    found = differing(rows, model).withColumn("power", F.greatest(F.lit(-35.0), F.least(F.lit(35.0), power)))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("power")))
    return found.select("row.*", score.alias("score"), (score >= least).cast("int").alias("predicted"))
