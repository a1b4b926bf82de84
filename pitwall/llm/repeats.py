"""Substring dedup: words in windows of k words that also start earlier are removed.

The k-word windows are the edges of a de Bruijn graph over the corpus. It is built only where
something repeats, and is never held as a graph of single edges:

1. Every window has an anchor, the leftmost least hash among its m-word grams. Equal windows
   have equal anchors, so only windows whose anchor value occurs at two places can repeat.
2. Consecutive candidate windows with one anchor are one run, a short path without a branch
   inside, named by a 128-bit BLAKE2 digest of its words. Runs that follow each other in all
   their occurrences compact into paths: at the first occurrence of each run, a run joins the
   one before it if that one is always followed by it and occurs as often.
3. Occurrences of a path's first run other than the earliest, found by a join, repeat the whole
   path: their coordinates give the removed spans.
4. Different runs may share single windows. Runs that share an anchor value with another run
   are opened into windows (digests again); those not at their earliest place are removed.

Documents with the text of an earlier one repeat it as a whole and take no part in 2 to 4.
Hot windows, runs and texts are reduced before shuffles and meet joins that Spark can split.

Words are runs of other bytes than white space (0x20, 0x09-0x0D), unchanged. A null text has
none. The earliest place is that of the smallest doc_id, then the earliest start; null
doc_ids come first; rows with one doc_id are documents of their own, in order of their text.
Every row gives a row. Other columns are ignored; an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.order import ordered
from pitwall.llm.tables import by_batch, stored
from pitwall.llm.words import NOT_SPACE, Words, split_words

ANCHOR_WORDS = 6
ROWS_OUT = 50_000
_RUN = pa.struct(
    [("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("run", pa.binary()), ("next", pa.binary())]
)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def window_anchors(words: Words, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the k-word windows within documents, the positions of their anchors, all gram hashes."""
    grams = words.grams(m)
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    width, span = k - m + 1, 1
    least, place = grams, np.arange(len(grams))
    while span < width:
        step = min(span, width - span)
        right_is_less = least[step:] < least[:-step]
        place = np.where(right_is_less, place[step:], place[:-step])
        least = np.where(right_is_less, least[step:], least[:-step])
        span += step
    ends = np.repeat(words.bounds[1:], np.diff(words.bounds))
    starts = np.flatnonzero(np.arange(n) + k <= ends[:n])
    return starts, place[starts], grams


def anchors(docs: DataFrame, k: int) -> DataFrame:
    """(anchor, ord, pos): every anchor position of every document."""

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ords = batch.column(0).to_numpy()
        for words in split_words(batch.column(1), NOT_SPACE):
            _, places, grams = window_anchors(words, k, ANCHOR_WORDS)
            places = places[np.append(True, places[1:] != places[:-1])] if len(places) else places
            doc = np.searchsorted(words.bounds, places, "right") - 1
            columns = [grams[places].view(np.int64), ords[words.first_row + doc], (places - words.bounds[doc]).astype("i4")]
            for at in range(0, len(places), ROWS_OUT):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[at : at + ROWS_OUT]) for c in columns], ["anchor", "ord", "pos"]
                )

    return docs.select("ord", "text").mapInArrow(by_batch(lambda: find), "anchor long, ord long, pos int")


def whole_texts(docs: DataFrame, k: int) -> DataFrame:
    """ord, doc_id, n_words and digest of all words of each document; whether an earlier one has its text."""

    def digests(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = [(text.as_py() or "").encode().split() for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([len(w) for w in words], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words]),
            ],
            ["ord", "doc_id", "n_words", "words_sha256"],
        )

    rows = stored(
        docs.select("ord", "doc_id", "text").mapInArrow(
            by_batch(lambda: digests), "ord long, doc_id long, n_words long, words_sha256 string"
        ),
        "texts",
    )
    firsts = rows.where(F.col("n_words") >= k).groupBy("words_sha256").agg(
        F.min("ord").alias("first_ord"), F.count("*").alias("n_texts")
    )
    shared = firsts.where("n_texts > 1").drop("n_texts")
    copied = rows.join(shared, "words_sha256", "left")
    return stored(copied.withColumn("is_copy", F.coalesce(F.col("first_ord") < F.col("ord"), F.lit(False))), "texts")


def candidate_runs(docs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Of each document that may repeat something and copies no other: ord, text, runs of candidate windows."""
    every = anchors(docs, k)
    repeated = every.groupBy("anchor").count().where("count > 1").select("anchor")
    places = (
        every.join(repeated, "anchor").groupBy("ord").agg(F.collect_list("pos").alias("places"))
        .join(texts.where(~F.col("is_copy")).select("ord"), "ord", "left_semi")
    )

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for words in split_words(batch.column(1), NOT_SPACE):
            runs = []
            starts, at, grams = window_anchors(words, k, ANCHOR_WORDS)
            cuts = np.searchsorted(starts, words.bounds)
            for d in range(words.n_docs):
                row, base = words.first_row + d, words.bounds[d]
                mine = slice(cuts[d], cuts[d + 1])
                wanted = batch.column(2)[row].values.to_numpy() + base
                chosen = np.isin(at[mine], wanted)
                text = batch.column(1)[row].as_py().encode().split()
                runs.append(_runs(starts[mine][chosen] - base, at[mine][chosen], grams, text, k))
            some = slice(words.first_row, words.first_row + words.n_docs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[some], batch.column(1)[some], pa.array(runs, pa.list_(_RUN))], ["ord", "text", "runs"]
            )

    ddl = "ord long, text string, runs array<struct<start: int, n: int, anchor: long, run: binary, next: binary>>"
    joined = docs.select("ord", "text").join(places, "ord").select("ord", "text", "places")
    return stored(joined.mapInArrow(by_batch(lambda: cut), ddl), "candidates")


def _runs(starts: np.ndarray, places: np.ndarray, grams: np.ndarray, text: list[bytes], k: int) -> list[tuple]:
    if not len(starts):
        return []
    begins = np.flatnonzero(np.append(True, (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)))
    lengths = np.diff(np.append(begins, len(starts)))
    first, values = starts[begins].tolist(), grams[places[begins]].view(np.int64).tolist()
    names = [_digest(text[s : s + n + k - 1]) for s, n in zip(first, lengths.tolist())]
    follows = [s + n == t for s, n, t in zip(first, lengths.tolist(), first[1:])] + [False]
    after = [name if f else None for name, f in zip([*names[1:], None], follows)]
    return [
        {"start": s, "n": n, "anchor": a, "run": r, "next": x}
        for s, n, a, r, x in zip(first, lengths.tolist(), values, names, after)
    ]


def compacted_paths(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each different run at its first place, and the repeated paths: first run, first place, windows, occurrences."""
    different = stored(
        runs.groupBy("run").agg(
            F.min(F.struct("ord", "start", "n", "anchor")).alias("first"), F.count("*").alias("times"),
            F.min("next").alias("next"), (F.min("next") == F.max("next")).alias("same"),
            (F.count("next") == F.count("*")).alias("always"),
        ).select("run", "first.*", "times", F.when(F.col("same") & F.col("always"), F.col("next")).alias("next")),
        "runs",
    )
    along = Window.partitionBy("ord").orderBy("start")
    before = {c: F.lag(c).over(along) for c in ("next", "times", "start", "n")}
    joins = (
        (before["next"] == F.col("run")) & (before["times"] == F.col("times"))
        & (before["start"] + before["n"] == F.col("start"))
    )
    heads = F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(along)
    paths = (
        different.where("times > 1").withColumn("path", heads).groupBy("ord", "path").agg(
            F.min(F.struct("start", "run")).alias("head"), F.sum("n").alias("n_windows"), F.first("times").alias("times")
        ).select(
            F.col("head.run").alias("run"), F.col("ord").alias("first_ord"), F.col("head.start").alias("first_start"),
            "n_windows", "times",
        )
    )
    return different, paths


def removed_spans(candidates: DataFrame, k: int) -> DataFrame:
    """(ord, start, end) in words of the spans that windows with earlier equals cover."""
    runs = candidates.select("ord", F.explode("runs").alias("r")).select("ord", "r.*")
    different, paths = compacted_paths(runs)
    later = (
        runs.select("run", "ord", "start").join(paths, "run")
        .where((F.col("ord") != F.col("first_ord")) | (F.col("start") != F.col("first_start")))
        .select("ord", "start", (F.col("start") + F.col("n_windows") + (k - 1)).cast("int").alias("end"))
    )
    shared = different.groupBy("anchor").count().where("count > 1").select("anchor")
    opened = different.join(shared, "anchor").groupBy("ord").agg(F.collect_list(F.struct("start", "n")).alias("opened"))

    def windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ords, starts, names = [], [], []
        for ord_, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            words = text.as_py().encode().split()
            for run in found:
                for at in range(run["start"], run["start"] + run["n"]):
                    ords.append(ord_)
                    starts.append(at)
                    names.append(_digest(words[at : at + k]))
        for at in range(0, len(ords), ROWS_OUT):
            some = slice(at, at + ROWS_OUT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[some], pa.binary()), pa.array(ords[some], pa.int64()), pa.array(starts[some], pa.int32())],
                ["window", "ord", "start"],
            )

    edges = stored(
        candidates.select("ord", "text").join(opened, "ord").select("ord", "text", "opened")
        .mapInArrow(by_batch(lambda: windows), "window binary, ord long, start int"),
        "windows",
    )
    first = edges.groupBy("window").agg(F.min(F.struct("ord", "start")).alias("first"), F.count("*").alias("n"))
    again = (
        edges.join(first.where("n > 1").select("window", "first"), "window")
        .where((F.col("ord") != F.col("first.ord")) | (F.col("start") != F.col("first.start")))
        .select("ord", "start", (F.col("start") + k).alias("end"))
    )
    return later.unionByName(again)


def without_repeats(documents: DataFrame, k: int = 20) -> DataFrame:
    """Of each document: ord, doc_id, n_words, n_removed, digest of the kept words, and for documents that
    keep only a part, the kept words; others keep all (``kept_text`` null, n_removed 0) or, as copies, none.
    """
    return without_repeats_in(ordered(documents), k)


def rewritten(documents: DataFrame, k: int = 20) -> DataFrame:
    """The rows of documents with what is left of their texts: the kept words, joined by single spaces, where
    words were removed, and else the text as it was. n_chars, if there, is counted anew.
    """
    docs = ordered(documents, whole=True)
    kept = without_repeats_in(docs.select("ord", "doc_id", "text"), k)
    changed = stored(kept.where("n_removed > 0").select("ord", "kept_text"), "kept")
    new = {"text": F.coalesce("kept_text", "row.text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("kept_text").isNull(), F.col("row.n_chars")).otherwise(F.char_length("kept_text"))
    names = [new[c].cast(documents.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`") for c in documents.columns]
    return docs.join(changed, "ord", "left").select(*names)


def without_repeats_in(docs: DataFrame, k: int) -> DataFrame:
    """As without_repeats, of documents in order (ord, doc_id, text)."""
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    texts = whole_texts(docs, k)
    candidates = candidate_runs(docs, texts, k)
    spans = removed_spans(candidates, k).groupBy("ord").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        removed, kept_texts, digests = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
            words = text.as_py().encode().split()
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, [s["start"] for s in spans], 1)
            np.add.at(depth, [s["end"] for s in spans], -1)
            kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()
            kept_text = b" ".join([words[i] for i in kept])
            removed.append(len(words) - len(kept))
            kept_texts.append(kept_text.decode())
            digests.append(hashlib.sha256(kept_text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(kept_texts), pa.array(digests)],
            ["ord", "cut", "kept_text", "kept"],
        )

    parts = (
        candidates.select("ord", "text").join(spans, "ord").select("ord", "text", "spans")
        .mapInArrow(by_batch(lambda: cut), "ord long, cut long, kept_text string, kept string")
    )
    nothing = hashlib.sha256(b"").hexdigest()
    copy = F.col("is_copy")
    return texts.join(parts, "ord", "left").select(
        "ord", "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(copy, nothing).otherwise(F.coalesce("kept", "words_sha256")).alias("kept_sha256"),
        F.when(copy, "").otherwise(F.col("kept_text")).alias("kept_text"),
    )
