"""Language identification by words first, backing off to character n-grams.

A word known from training counts with the logarithm of its frequency in each language. An
unknown word is scored by its longest character n-grams that are known, from five letters
(with the marks at its ends) down to one. The words' scores add up, and the languages' shares
of the likelihood give the prediction and its score.

Counts are taken by Spark over a bounded sample of the training texts, chosen by a hash of the
text, so that it does not matter which rows share an id: every language gives about as many
different texts, or all it has if these are fewer, and a copied text counts as often as it
stands there. The model keeps the words and n-grams that occur more than once in the sample, and
all n-grams of one or two letters. So the sample bounds its size too; neither depends on how
common a language is.

Words are runs of letters, lower-cased. A text that is null or has no letter is ``und`` with
score 0; so is every text if there is nothing to learn from. A text none of whose letters is
known gets the most frequent language. Nothing but the text enters a prediction: rows with one
doc_id, also null, are predicted each. An empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import by_batch, release_memory, small_batches
from pitwall.llm.words import LetterWords, letter_words

#: Training texts in the sample, about, and how often the sample must show a word or an n-gram.
SAMPLE_DOCUMENTS, LEAST_TIMES = 20_000, 2
LONGEST_GRAM, SHORT_GRAM = 5, 2
SMOOTHING = 0.1
UNKNOWN = "und"
#: Parts per million, for a sampling threshold.
PARTS = 1_000_000_000


@dataclass
class Model:
    """Log frequencies per language of words (gram length 0) and n-grams, by sorted hash."""

    languages: list[str]
    common: int
    hashes: dict[int, np.ndarray]
    scores: dict[int, np.ndarray]

    def look_up(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is known, and its entry."""
        known = self.hashes[n]
        if not len(known):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return known[at] == hashes, at

    def word_scores(self, words: LetterWords, first: np.ndarray) -> np.ndarray:
        """The scores of the words with these numbers."""
        known, at = self.look_up(0, words.hashes[first])
        scores = np.zeros((len(first), len(self.languages)))
        scores[known] = self.scores[0][at[known]]
        left = np.flatnonzero(~known)
        for n in range(LONGEST_GRAM, 0, -1):
            if not len(left):
                break
            begins, ends = _gram_span(words, first[left], n)
            counts = np.maximum(0, ends - begins)
            owner = np.repeat(np.arange(len(left)), counts)
            places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
            known, at = self.look_up(n, words.letter_grams(places, n))
            found = np.bincount(owner[known], minlength=len(left))
            total = np.stack(
                [np.bincount(owner[known], column[at[known]], len(left)) for column in self.scores[n].T], 1
            )
            some = found > 0
            scores[left[some]] = total[some] / found[some, None]
            left = left[~some]
        return scores


def _gram_span(words: LetterWords, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the n-grams of words begin, and the end of those places. Longer ones take in the marks around a word."""
    mark = 1 if n > 1 else 0
    return words.starts[which] - mark, words.ends[which] + mark - n + 1


def _counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(n, hash, lang, times) of the words and n-grams of (text, lang, copies)."""
    languages, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
    for words in letter_words(batch.column(0)):
        doc = np.repeat(np.arange(words.n_docs), np.diff(words.bounds)) + words.first_row
        of_word = languages[doc]
        for language in np.unique(of_word.astype(str)):
            mine = np.flatnonzero(of_word == language)
            for n in range(LONGEST_GRAM + 1):
                if n:
                    begins, ends = _gram_span(words, mine, n)
                    counts = np.maximum(0, ends - begins)
                    places = np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                    hashes, weights = words.letter_grams(places, n), np.repeat(copies[doc[mine]], counts)
                else:
                    hashes, weights = words.hashes[mine], copies[doc[mine]]
                values, which = np.unique(hashes, return_inverse=True)
                times = np.bincount(which, weights, len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(values), n, np.int32)), pa.array(values.view(np.int64)),
                        pa.array([language] * len(values), pa.string()), pa.array(times),
                    ],
                    ["n", "hash", "lang", "times"],
                )


def _quota(sizes: list[int], most: int) -> int:
    """The most rows that each of groups of these sizes can give, with no more than most in all."""
    quota = most
    for i, size in enumerate(sorted(sizes)):
        quota = most // (len(sizes) - i)
        if size > quota:
            break
        most -= size
    return max(1, quota)


def trained(documents: DataFrame, learn_from: Column, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Learns from text and lang of about so many of the rows that learn_from admits, or fewer."""
    small_batches(documents.sparkSession)
    rows = documents.where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    # The numbers of different texts are estimates, from bounded sketches.
    pick = F.xxhash64("text", F.lit("sample"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct(pick, 0.02).alias("texts"), F.count(F.lit(1)).alias("rows"))
    found = counted.collect()
    sizes, common = {r["lang"]: r["texts"] for r in found}, {r["lang"]: r["rows"] for r in found}
    quota = _quota(list(sizes.values()), sample_documents)
    shares = F.broadcast(documents.sparkSession.createDataFrame(
        [(lang, PARTS if n <= quota else PARTS * quota // n + 1) for lang, n in sizes.items()], "lang string, share long",
    ))
    chosen = rows.join(shares, "lang").where(F.pmod(pick, F.lit(PARTS)) < F.col("share"))
    texts = chosen.groupBy("text", "lang").agg(F.count(F.lit(1)).alias("copies"))
    counts = texts.mapInArrow(
        by_batch(lambda: _counts), "n int, hash long, lang string, times long"
    )
    entries = counts.groupBy("n", "hash", "lang").agg(F.sum("times").alias("times")).groupBy("n", "hash").agg(
        F.sum("times").alias("times"), F.collect_list(F.struct("lang", "times")).alias("by_lang")
    )
    kept = entries.where((F.col("times") >= LEAST_TIMES) | F.col("n").between(1, SHORT_GRAM))
    return _model(kept.select("n", "hash", "by_lang").toArrow(), common)


def _model(table: pa.Table, sizes: dict[str, int]) -> Model:
    by_lang = table["by_lang"].combine_chunks()
    entry = np.repeat(np.arange(len(table)), by_lang.value_lengths().to_numpy())
    found = by_lang.flatten()
    names = found.field("lang").to_numpy(zero_copy_only=False).astype(str)
    languages = sorted(set(names.tolist()))
    counts = np.zeros((len(table), len(languages)))
    if languages:
        counts[entry, np.searchsorted(languages, names)] = found.field("times").to_numpy()
    lengths, hashes = table["n"].to_numpy(), table["hash"].to_numpy().view(np.uint64)
    model = Model(languages, 0, {}, {})
    for n in range(LONGEST_GRAM + 1):
        rows = np.flatnonzero(lengths == n)
        rows = rows[np.argsort(hashes[rows])]
        some = counts[rows] + SMOOTHING
        model.hashes[n] = hashes[rows]
        model.scores[n] = np.log(some / some.sum(0)) if len(rows) else some
    if languages:
        model.common = int(np.argmax([sizes[language] for language in languages]))
    return model


def _predictions(texts: pa.Array, model: Model) -> pa.StructArray:
    names, shares, letters = [], [], []
    for words in letter_words(texts):
        n_words = np.diff(words.bounds)
        letters += (n_words > 0).tolist()
        if not model.languages:
            names += [UNKNOWN] * words.n_docs
            shares += [0.0] * words.n_docs
            continue
        _, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
        scores = model.word_scores(words, first)[number]
        np.cumsum(scores, 0, out=scores)
        ends = np.vstack([np.zeros((1, scores.shape[1])), scores])
        sums = ends[words.bounds[1:]] - ends[words.bounds[:-1]]
        likely = np.exp(np.clip(sums - sums.max(1, keepdims=True), -700, 0))
        likely /= likely.sum(1, keepdims=True)
        best = np.where(np.ptp(sums, 1) == 0, model.common, likely.argmax(1))
        share = likely[np.arange(words.n_docs), best]
        names += [model.languages[b] if n else UNKNOWN for b, n in zip(best, n_words)]
        shares += np.where(n_words > 0, share, 0.0).tolist()
    columns = [pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(letters, pa.bool_())]
    return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "has_letter"])


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with ``predicted`` (lang_pred, score, has_letter). The model goes to the executors once; only texts go
    to Python, and only predictions come back."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, has_letter: boolean>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _predictions(texts, shared.value)
        release_memory()

    # Spark may otherwise evaluate it once for a filter and once more for the result.
    return documents.withColumn("predicted", predict.asNondeterministic()(F.col("text").cast("string")))


def identified(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of documents that have a letter, whether or not the model knows a language; the others are rejected."""
    rows = documents.select(F.struct("*").alias("row"), F.col("text"))
    return predicted(rows, model).where("predicted.has_letter").select("row.*")
