"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text has a hash for each k consecutive words. Of each sliding window of 13 words the
leftmost least of its k-gram hashes is kept. Two texts that share 13 consecutive words keep the
same k-gram there, so a join of kept hashes finds every shared window; it also fixes how the
item lies over the document. Each hit is extended: item and document words are compared along
that alignment, and the windows of 13 equal words are the occurrences. Items shorter than 13
words are one window; documents are searched for a hash of all their words, for the few
lengths that occur.

Only hashes and, once, the documents' texts are shuffled. The sides of the hash join are left
to Spark, which broadcasts the benchmark only if it is small and splits hot hashes otherwise.

Words are runs of other characters than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F after A-Z are
lower-cased. Null and wordless texts have no words: such documents have no hits, such items do
not occur. Documents with one doc_id, also null, are told apart. Items with one item_id are
matched each and counted once; a null item_id counts as an empty one. Other columns are
ignored; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.order import ordered
from pitwall.llm.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS, GRAM_WORDS = 13, 5


def words_of(text: str) -> Column:
    return F.coalesce(
        F.array_remove(F.split(F.translate(F.col(text).cast("string"), UPPER, LOWER), BETWEEN_WORDS), ""), F.array()
    )


def _places(first: int, last: Column) -> Column:
    """The whole numbers from first to last; none if last is less."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def fingerprints(texts: DataFrame, key: str, window: int, k: int) -> DataFrame:
    """(key, place, value): the winnowed k-gram hashes of texts (key, words) and where they begin."""
    width = window - k + 1
    hashed = texts.select(
        key, F.transform(
            _places(0, F.size("words") - k), lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(k)))
        ).alias("hashes"),
    )
    def leftmost(i: Column) -> Column:
        around = F.slice("hashes", i + 1, width)
        return i + F.array_position(around, F.array_min(around)).cast("int") - 1

    kept = F.array_distinct(F.transform(_places(0, F.size("hashes") - width), leftmost))
    return hashed.select(
        key, F.explode(F.transform(kept, lambda p: F.struct(p.alias("place"), F.get("hashes", p).alias("value")))).alias("f")
    ).select(key, "f.place", "f.value")


def whole_hashes(texts: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, place, value): a hash for each run of so many words."""
    def hashed(n: int) -> Column:
        def at(i: Column) -> Column:
            value = F.xxhash64(F.lit(n), *(F.get("words", i + j) for j in range(n)))
            return F.struct(i.alias("place"), value.alias("value"))

        return F.transform(_places(0, F.size("words") - n), at)

    every = F.flatten(F.array(*map(hashed, lengths)))
    return texts.select(key, F.explode(every).alias("f")).select(key, "f.place", "f.value")


def alignments(docs: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """(ord, item, shift): documents and items with an equal kept hash, and how far the item is shifted."""
    long_items = items.where(F.size("words") >= window)
    found = fingerprints(docs, "ord", window, k).join(
        fingerprints(long_items, "item", window, k).withColumnRenamed("place", "item_place"), "value"
    ).select("ord", "item", (F.col("place") - F.col("item_place")).alias("shift"))
    short_items = items.where((F.size("words") > 0) & (F.size("words") < window))
    # At most window - 1 numbers.
    lengths = sorted(row[0] for row in short_items.select(F.size("words")).distinct().collect())
    if lengths:
        whole = short_items.select(
            "item", F.coalesce(*(
                F.when(F.size("words") == n, F.xxhash64(F.lit(n), *(F.get("words", F.lit(j)) for j in range(n))))
                for n in lengths
            )).alias("value"),
        )
        short = whole_hashes(docs, "ord", lengths).join(whole, "value")
        found = found.unionByName(short.select("ord", "item", F.col("place").alias("shift")))
    return found


def _equal_words(hit: Column) -> Column:
    """For each word of the item, 1 if the document has it at its place along the alignment, else 0."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.size(hit["item_words"]) - 1),
            lambda j: F.when(F.get("words", j + hit["shift"]) == F.get(hit["item_words"], j), "1").otherwise("0"),
        ), "",
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, k: int = GRAM_WORDS) -> DataFrame:
    """Of each document: ord, doc_id, n_words, n_hit, n_items, digest of the items' ids, contaminated."""
    return decontaminated_in(ordered(documents), benchmark, window, k)


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that are not contaminated."""
    docs = ordered(documents, whole=True)
    found = decontaminated_in(docs.select("ord", "doc_id", "text"), benchmark)
    return docs.join(stored(found.where("contaminated").select("ord"), "gone"), "ord", "left_anti").select("row.*")


def decontaminated_in(
    texts: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, k: int = GRAM_WORDS
) -> DataFrame:
    """As decontaminated, of documents in order (ord, doc_id, text)."""
    docs = texts.select("ord", words_of("text").alias("words"))
    items = benchmark.select(
        F.struct(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), words_of("text").alias("words")).alias("item")
    ).distinct().select("item", "item.words")
    hits = (
        alignments(docs, items, window, k).groupBy("ord")
        .agg(F.collect_set(F.struct(F.col("item.id").alias("id"), F.col("item.words").alias("item_words"), "shift")).alias("hits"))
    )
    aligned = texts.join(hits, "ord", "left").select("ord", "doc_id", words_of("text").alias("words"), "hits")
    compared = aligned.select(
        "ord", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.transform(
            F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType)),
            lambda h: F.struct(
                h["id"].alias("id"), h["shift"].alias("shift"), F.size(h["item_words"]).alias("n"), _equal_words(h).alias("equal")
            ),
        ).alias("hits"),
    )

    def covered(hit: Column) -> Column:
        """The document's words inside windows that are equal throughout."""
        length = F.least(F.lit(window), hit["n"])
        starts = F.filter(
            F.sequence(F.lit(1), hit["n"] - length + 1),
            lambda s: F.substring(hit["equal"], s, length) == F.repeat(F.lit("1"), length),
        )
        return F.flatten(F.transform(starts, lambda s: F.sequence(s - 1 + hit["shift"], s + hit["shift"] + length - 2)))

    occurring = compared.select(
        "ord", "doc_id", "n_words",
        F.filter(
            F.transform("hits", lambda h: F.struct(h["id"].alias("id"), covered(h).alias("places"))),
            lambda h: F.size(h["places"]) > 0,
        ).alias("hits"),
    )
    counted = occurring.select(
        "ord", "doc_id", "n_words",
        F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["places"])))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["id"]))).alias("items"),
    )
    return counted.select(
        "ord", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
