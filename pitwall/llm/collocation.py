"""Collocations: frequent phrases, found by mergeable Misra-Gries summaries and then counted exactly.

Texts are lower-cased (A-Z), cut into pieces and words; a phrase lies within a piece. All counts
are per language, null being ``und``.

First pass, length by length (words, pairs, three to five words): tasks count phrase hashes and
send them, packed, to hash partitions. Each partition keeps a Misra-Gries summary whose capacity
exceeds its mass divided by the least count. What a summary has subtracted stays below that
count, so no frequent phrase is lost. Its survivors go into a filter of fixed size, a bit for
each slice of the hashes; a longer phrase is only counted if the filter has all pairs (or words)
in it. So collisions only let more through. Second pass: phrases that the filter lets through
are counted exactly, by their words.

Null texts are empty, and texts without words count for nothing. Rows with one doc_id are
documents each; only text and lang are read. An empty table gives no rows. Long texts are taken
in chunks, so memory follows the longest text. Scores are exact while counts stay below 9e15.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.tables import release_memory, small_batches, stored
from pitwall.llm.words import ASCII_LOWER, byte_set, mixed, split_words

LONGEST = 5
#: End a piece: . , ; : ! ? and 0A to 0D. Words are also cut at space and tab.
PIECE_ENDS = frozenset([*b".,;:!?", *range(0x0A, 0x0E)])
_IS_WORD = byte_set(PIECE_ENDS | {0x20, 0x09})
_ENDS_PIECE = ~byte_set(PIECE_ENDS)
#: Bits of the filter, whatever the input: 16 MB.
FILTER_BITS = 1 << 27
#: Entries a task holds before it sends its counts, and entries of a packed row.
HELD, PACKED = 1 << 21, 1 << 14
#: Capacity of a summary as a multiple of mass over least count, and the most entries planned for one.
SLACK, SUMMARY = 4, 1 << 19
LEAST_PARTS, MOST_PARTS = 32, 1 << 16
#: Shares of a language's phrases that are ranked apart, before the first of each are ranked together.
SHARES = 64
#: Lengths of phrases counted by one run of the first pass; those before are in the filter by then.
LEVELS = ((1,), (2,), (3, 4, 5))


class Phrases:
    """Hashes of the phrases of a chunk of texts, with their language."""

    def __init__(self, words, languages: np.ndarray, language_hashes: np.ndarray):
        self.words = words
        doc = np.repeat(np.arange(words.n_docs), np.diff(words.bounds))
        ended = np.append(0, np.cumsum(_ENDS_PIECE[words.data]))
        apart = (doc[1:] != doc[:-1]) | (ended[words.starts[1:]] > ended[words.ends[:-1]]) if len(doc) else np.zeros(0, bool)
        #: Of each word, how many words its piece has from there on.
        last = np.append(np.flatnonzero(apart), len(doc) - 1)
        self.left = (last[np.searchsorted(last, np.arange(len(doc)))] - np.arange(len(doc)) + 1) if len(doc) else doc
        self.language = languages[words.first_row + doc]
        self.salt = language_hashes[self.language]

    def of_length(self, k: int, lane: int = 0) -> np.ndarray:
        """The hash of the k words from each word on; only those inside a piece mean anything."""
        n, grams = len(self.left), self.words.grams(k, lane)
        found = np.zeros(n, np.uint64)
        found[: len(grams)] = mixed(grams ^ self.salt[: len(grams)])
        return found

    def text(self, at: int, k: int) -> str:
        data, starts, ends = self.words.data, self.words.starts, self.words.ends
        return b" ".join(data[starts[i] : ends[i]].tobytes() for i in range(at, at + k)).decode()


def _phrases(batch: pa.RecordBatch) -> Iterator[tuple[Phrases, list[str]]]:
    """Of (text, lang)."""
    coded = batch.column(1).cast(pa.string()).dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.array([_language_hash(name) for name in names], np.uint64)
    languages = coded.indices.to_numpy()
    for words in split_words(batch.column(0), _IS_WORD, ASCII_LOWER):
        yield Phrases(words, languages, hashes), names


def _language_hash(name: str) -> int:
    value = 0xCBF29CE484222325
    for byte in name.encode():
        value = ((value ^ byte) * 0x100000001B3) % 2**64
    return value


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter has the hashes: a bit by the leading bits of a hash."""
    at = hashes >> np.uint64(64 - (8 * len(bits) - 1).bit_length())
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _possible(phrases: Phrases, k: int, bits: np.ndarray | None) -> np.ndarray:
    """Where a phrase of k words begins whose shorter parts, of the level before, are all in the filter."""
    inside = phrases.left >= k
    if k == 1 or bits is None:
        return np.flatnonzero(inside)
    part = 1 if k == 2 else 2
    known = passes(bits, phrases.of_length(part)) & (phrases.left >= part)
    for shift in range(k - part + 1):
        inside[: len(inside) - shift] &= known[shift:]
        inside[len(inside) - shift :] = False
    return np.flatnonzero(inside)


class MisraGries:
    """Counts of hashes, too low by ``error`` at most, which stays below ``least``.

    Counts of many hashes are added at a time. Over its capacity the summary subtracts the count
    of the first entry that is too many from all and drops those at zero. Where the error would
    reach ``least`` the capacity is doubled instead.
    """

    def __init__(self, capacity: int, least: int):
        self.capacity, self.least, self.error = max(1, capacity), least, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, where = np.unique(np.concatenate([self.hashes, hashes]), return_inverse=True)
        both = np.concatenate([self.counts, counts])
        self.counts = np.zeros(len(self.hashes), np.int64)
        np.add.at(self.counts, where, both)
        while len(self.hashes) > self.capacity:
            place = len(self.hashes) - self.capacity - 1
            over = int(np.partition(self.counts, place)[place])
            if self.error + over >= self.least:
                self.capacity *= 2
                continue
            self.error += over
            kept = self.counts > over
            self.hashes, self.counts = self.hashes[kept], self.counts[kept] - over

    def survivors(self) -> np.ndarray:
        """All hashes whose true count may be the least count or more."""
        return self.hashes[self.counts + self.error >= self.least]


def _packed(held: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """(part, hashes, counts) rows of a task's hashes; a hash's leading bits are its part."""
    hashes, counts = np.unique(np.concatenate(held), return_counts=True)
    shift = np.uint64(64 - (parts - 1).bit_length())
    cuts = np.searchsorted(hashes >> shift, np.arange(parts + 1, dtype=np.uint64))
    rows = [(p, a, min(a + PACKED, cuts[p + 1])) for p in range(parts) for a in range(cuts[p], cuts[p + 1], PACKED)]
    for at in range(0, len(rows), 64):
        some = rows[at : at + 64]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([p for p, _, _ in some], pa.int32()),
            "hashes": pa.array([hashes[a:b].tobytes() for _, a, b in some], pa.binary()),
            "counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for _, a, b in some], pa.binary()),
        })


def _survivors(rows: DataFrame, lengths: tuple[int, ...], bits, mass: int, least: int) -> np.ndarray:
    """The filter of the phrases of these lengths that may be frequent; mass bounds their occurrences."""
    spark = rows.sparkSession
    parts = _parts(mass, least)
    capacity = SLACK * mass // (parts * least) + 1
    # A slice of the filter has eight bits at least.
    slice_bits = FILTER_BITS // parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for phrases, _ in _phrases(batch):
                for k in lengths:
                    at = _possible(phrases, k, None if bits is None else bits.value)
                    held.append(phrases.of_length(k)[at])
                    n += len(at)
                if n >= 2 * HELD:
                    yield from _packed(held, parts)
                    held, n = [], 0
        if n:
            yield from _packed(held, parts)
        release_memory()

    def summarise(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, some, n = MisraGries(capacity, least), ([], []), 0
        for batch in batches:
            for hashes, counts in zip(batch.column(1), batch.column(2)):
                some[0].append(np.frombuffer(hashes.as_buffer(), np.uint64))
                some[1].append(np.frombuffer(counts.as_buffer(), np.uint32))
                n += len(some[0][-1])
                if n >= max(HELD // 2, summary.capacity):
                    summary.add(np.concatenate(some[0]), np.concatenate(some[1]))
                    some, n = ([], []), 0
        if n:
            summary.add(np.concatenate(some[0]), np.concatenate(some[1]))
        at = summary.survivors() >> np.uint64(64 - (FILTER_BITS - 1).bit_length())
        slice_ = np.zeros(slice_bits, bool)
        slice_[(at % np.uint64(slice_bits)).astype(np.int64)] = True
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([key[0].as_py()], pa.int32()),
            "bits": pa.array([np.packbits(slice_, bitorder="little").tobytes()], pa.binary()),
        })

    packed = rows.mapInArrow(count, "part int, hashes binary, counts binary")
    # One slice of the filter from each part: its fixed size in all.
    slices = packed.groupBy("part").applyInArrow(summarise, "part int, bits binary").toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, found in zip(slices["part"].to_pylist(), slices["bits"].to_pylist()):
        at = part * slice_bits // 8
        bits[at : at + slice_bits // 8] = np.frombuffer(found, np.uint8)
    return bits


def _exact(rows: DataFrame, bits, parts: int, least: int) -> DataFrame:
    """(lang, k, phrase, times) of all phrases that the filter lets through and that are frequent; k = 0 counts all words.

    Tasks send their counts packed, by the part of a phrase's hash, and each part adds them up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        totals: dict[str, int] = {}
        for batch in batches:
            for phrases, names in _phrases(batch):
                for code, n in enumerate(np.bincount(phrases.language, minlength=len(names)).tolist()):
                    if n:
                        totals[names[code]] = totals.get(names[code], 0) + n
                for k in range(1, LONGEST + 1):
                    at = _possible(phrases, k, bits.value)
                    first = phrases.of_length(k)[at]
                    at = at[passes(bits.value, first)]
                    if not len(at):
                        continue
                    a, b = phrases.of_length(k)[at], phrases.of_length(k, 1)[at]
                    order = np.lexsort((b, a))
                    a, b = a[order], b[order]
                    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                    times = np.diff(np.append(new, len(a)))
                    keys = zip(a[new].tolist(), b[new].tolist())
                    for i, n, key in zip(at[order[new]].tolist(), times.tolist(), keys):
                        known = found.get(key)
                        if known:
                            known[3] += n
                        else:
                            found[key] = [names[phrases.language[i]], k, phrases.text(i, k), n]
                if len(found) >= HELD // 4:
                    yield from _by_part(found, parts)
                    found = {}
        # The words of a language are counted in its own part.
        found |= {(_language_hash(name), -1): [name, 0, "", n] for name, n in totals.items()}
        yield from _by_part(found, parts)
        release_memory()

    def add_up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, some, n = None, [], 0
        for batch in batches:
            some.append(pa.table({name: batch.column(name).flatten() for name in COUNTED}))
            n += len(some[-1])
            if n >= HELD:
                sums = _sums(sums, some)
                some, n = [], 0
        sums = _sums(sums, some)
        frequent = (sums["times"].to_numpy() >= least) | (sums["k"].to_numpy() == 0)
        yield from sums.filter(pa.array(frequent)).select(COUNTED).combine_chunks().to_batches()

    packed = rows.mapInArrow(
        count, "part int, lang array<string>, k array<int>, phrase array<string>, times array<long>"
    )
    return packed.groupBy("part").applyInArrow(add_up, "lang string, k int, phrase string, times long")


COUNTED = ["lang", "k", "phrase", "times"]


def _sums(sums: pa.Table | None, some: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables([*([] if sums is None else [sums]), *some])
    return table.group_by(["lang", "k", "phrase"]).aggregate([("times", "sum")]).rename_columns(
        {"times_sum": "times"}
    ).select(COUNTED)


def _by_part(found: dict[tuple[int, int], list], parts: int) -> Iterator[pa.RecordBatch]:
    """Packed rows of counted phrases."""
    shift = 64 - (parts - 1).bit_length()
    of_part: dict[int, list] = {}
    for (first, _), entry in found.items():
        of_part.setdefault(first >> shift, []).append(entry)
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]
    for part, entries in of_part.items():
        for at in range(0, len(entries), PACKED):
            columns = [pa.array([list(column)], pa.list_(kind)) for column, kind in zip(zip(*entries[at : at + PACKED]), kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *columns], ["part", *COUNTED])


def _parts(mass: int, least: int) -> int:
    """Hash partitions, a power of two, so that no summary is planned larger than SUMMARY."""
    parts = LEAST_PARTS
    while parts < MOST_PARTS and SLACK * mass > SUMMARY * least * parts:
        parts *= 2
    return parts


def phrase_counts(documents: DataFrame, least: int) -> DataFrame:
    """(lang, k, phrase, times): every phrase of up to five words that occurs as often as least, and all words (k = 0)."""
    rows = documents.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
    )
    small_batches(documents.sparkSession)
    # A word and what ends it take two bytes.
    words = rows.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0
    context, bits, shared = documents.sparkSession.sparkContext, None, None
    for lengths in LEVELS:
        found = _survivors(rows, lengths, shared, int(words) * len(lengths) + 1, least)
        bits = found if bits is None else bits | found
        if shared is not None:
            shared.unpersist()
        shared = context.broadcast(bits)
    return stored(_exact(rows, shared, _parts(int(words) * LONGEST, least), least), "phrases")


def _part(words: str, start: int | F.Column, length: F.Column) -> F.Column:
    return F.array_join(F.slice(F.col(words), start, length), " ")


def collocations(documents: DataFrame, least: int = 100, most: int = 2_000) -> DataFrame:
    """The first phrases of each language by score: lang, rank, phrase, a, l, r, n, score."""
    counts = phrase_counts(documents, least)
    totals = counts.where("k = 0").select("lang", F.col("times").alias("n"))
    phrases = counts.where("k > 1").select(
        "lang", "phrase", "k", F.col("times").alias("a"), F.split("phrase", " ").alias("words")
    )
    parts = counts.where("k > 0").select("lang", "phrase", "times")
    # A phrase in a longer one as frequent is also in one longer by a word and as frequent.
    longer = phrases.where("k > 2").select(
        "lang", "a", F.explode(F.array(
            _part("words", 1, F.col("k") - 1), _part("words", 2, F.col("k") - 1)
        )).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("a").alias("in_longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where("in_longer IS NULL OR 100 * in_longer < 100 * a")
    cuts = kept.select("lang", "phrase", "k", "a", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _part("words", 1, F.col("cut")).alias("head"),
        _part("words", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    scored = (
        cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("times").alias("l")), ["lang", "head"])
        .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("times").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", F.expr(
            "(CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
        ))
    )
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.max("a").alias("a"), F.max("n").alias("n")
    )
    ranked = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of each share of a language, then the first of all, so that no task gets a language whole.
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    for keys in (["lang", share], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
