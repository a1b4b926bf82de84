"""Toxicity by logistic regression with the FTRL-proximal update, over hashed word features.

A text's features are the hashes of its lower-cased words, of its word pairs, and of pairs with
one and two words skipped, each counted as present or not. Every coordinate has its own rate,
which falls with the gradients it has seen, and L1 keeps most weights at zero, so that the model
is a short list of weights.

Labels are a bounded sample, the rows with the least hash of doc_id; the documents they name are
found by a join. Each round, shards of the sample update the state from the round before, and
their states are averaged. Scoring needs no shuffle.

A null or empty text has no features and the score of the bias. Rows with a null label or of
documents that do not exist are not learnt from; if there are none, every score is 0.5. Rows
with one doc_id, also null, are scored each. An empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import release_memory, stored
from pitwall.llm.words import LetterWords, letter_words, mixed

SAMPLE_LABELS = 16_384
DIMENSIONS = 1 << 20
SHARDS, ROUNDS = 2, 6
RATE, RATE_OFFSET, L1, L2 = 2.0, 1.0, 8.0, 0.1
BIAS = 0
#: Words between the first and the second of a pair, plus one.
GAPS = (1, 2, 3)


def features(words: LetterWords) -> tuple[np.ndarray, np.ndarray]:
    """Document and feature of every word, pair and skipped pair of a chunk, repeats included."""
    doc = np.repeat(np.arange(words.n_docs), np.diff(words.bounds))
    docs, hashes = [doc], [words.hashes]
    for gap in GAPS:
        within = np.flatnonzero(doc[gap:] == doc[:-gap])
        docs.append(doc[within])
        hashes.append(mixed(words.hashes[within] * np.uint64(2 * gap + 1) + words.hashes[within + gap]))
    found = np.concatenate(hashes) % np.uint64(DIMENSIONS - 1) + np.uint64(1)
    return np.concatenate(docs), found.astype(np.int64)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that a state stands for; the bias is not shrunk to zero."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    if len(z) == DIMENSIONS:
        shrunk[BIAS] = z[BIAS]
    return -shrunk / ((RATE_OFFSET + np.sqrt(n)) / RATE + L2)


def _update(z: np.ndarray, n: np.ndarray, present: np.ndarray, label: int) -> None:
    """One step with the features that are present, the bias (first) among them."""
    zs, ns = z[present], n[present]
    shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
    shrunk[0] = zs[0]
    w = -shrunk / ((RATE_OFFSET + np.sqrt(ns)) / RATE + L2)
    gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
    squares = ns + gradient * gradient
    z[present] = zs + gradient - (np.sqrt(squares) - np.sqrt(ns)) / RATE * w
    n[present] = squares


def trained(documents: DataFrame, labels: DataFrame, learn_from: Column, sample_labels: int = SAMPLE_LABELS) -> np.ndarray:
    """Dense weights, learnt from (doc_id, toxic) rows that learn_from admits."""
    spark = documents.sparkSession
    # The sample's rows are two numbers each, and their count is bounded: it may be broadcast.
    sample = (
        labels.where(learn_from & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("labelled"), (F.col("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled", F.lit("sample")), "labelled", "toxic").limit(sample_labels)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))
    order = F.xxhash64("labelled", F.lit("order"))
    rows = stored(
        texts.select(
            F.col("text").cast("string").alias("text"), "toxic", order.alias("turn"),
            F.pmod(order, F.lit(SHARDS)).cast("int").alias("shard"),
        ),
        "labelled",
    )
    state = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for _ in range(ROUNDS):
        before = spark.sparkContext.broadcast(state)

        def learn(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z, n = (x.copy() for x in before.value)
            for batch in batches:
                toxic = batch.column(1).to_pylist()
                for words in letter_words(batch.column(0)):
                    doc, found = features(words)
                    found = found[np.argsort(doc, kind="stable")]
                    cuts = np.append(0, np.cumsum(np.bincount(doc, minlength=words.n_docs)))
                    for d in range(words.n_docs):
                        present = np.append(BIAS, np.unique(found[cuts[d] : cuts[d + 1]]))
                        _update(z, n, present, toxic[words.first_row + d])
            yield pa.RecordBatch.from_pydict({"z": [z.astype("f4").tobytes()], "n": [n.astype("f4").tobytes()]})

        shards = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "turn", "text").groupBy("shard")
        states = shards.applyInArrow(learn, "z binary, n binary").toArrow().to_pylist()
        if not states:
            break
        state = tuple(
            np.mean([np.frombuffer(s[name], "f4") for s in states], 0, dtype=np.float64) for name in ("z", "n")
        )
        before.unpersist()
    return weights(*state)


def _scores(texts: pa.Array, dense: np.ndarray) -> pa.Array:
    scores = [np.zeros(0)]
    for words in letter_words(texts):
        doc, found = features(words)
        weighted = np.flatnonzero(dense[found])
        once = np.unique(doc[weighted] * DIMENSIONS + found[weighted])
        sums = np.bincount(once // DIMENSIONS, dense[once % DIMENSIONS], words.n_docs)
        scores.append(1 / (1 + np.exp(-np.clip(sums + dense[BIAS], -35, 35))))
    return pa.array(np.concatenate(scores))


def scored(documents: DataFrame, learnt: np.ndarray) -> DataFrame:
    """The documents with score and predicted. Only weights other than zero are sent out, only texts go to
    Python, and only scores come back."""
    used = np.flatnonzero(learnt)
    shared = documents.sparkSession.sparkContext.broadcast((used, learnt[used].astype(np.float32)))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = np.zeros(DIMENSIONS)
        dense[shared.value[0]] = shared.value[1]
        for texts in batches:
            yield _scores(texts, dense)
        release_memory()

    found = documents.withColumn("score", score.asNondeterministic()(F.col("text").cast("string")))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
