"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Every document has the set of its distinct shingles of k words. SuperMinHash gives each
element the ranks of one random permutation of the signature's slots: an element is seen
with rank 0 at one slot, rank 1 at another, and so on, and the signature is complete as soon
as no later rank can lower any slot. Bands of slots give candidates; all links are confirmed
on full sets.

Documents with equal sets are one class, and a class is compared once. Classes that share a
band are linked without looking at all pairs of a bucket:

1. A shingle that no other candidate has cannot be shared. A class too many of whose shingles
   are its own can link with nothing and is left out; the same counts bound any pair's similarity.
2. Twice, all classes of a bucket are compared with one of them, and linked classes become
   components.
3. What is left are pairs that share a bucket and lie in different components. Classes outside
   a bucket's largest component are compared with each other, and with all of that component:
   block by block, in pieces of work that give one link for each class that has any, or links
   that connect what is similar. Only in a bucket with few classes outside they are joined in pairs.

With 40 bands of 4 slots a pair at similarity 0.75 shares no band once in four million.

Words are runs of other bytes than white space (0x20, 0x09-0x0D) after A-Z are lower-cased.
With fewer than k words the whole sequence is the one shingle; null or wordless texts have
the empty set, link with nothing, and are kept. Rows with one doc_id, also null, are
documents of their own; a component is named by its smallest doc_id, nulls first. Other
columns are ignored; an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.components import components
from pitwall.llm.order import ordered
from pitwall.llm.tables import by_batch, in_groups, stored
from pitwall.llm.words import ASCII_LOWER, NOT_SPACE, Words, mixed, span_sums, split_words

SHINGLE_WORDS, BANDS, BAND_SLOTS = 5, 40, 4
#: Sets of each kind in a piece of work, and shingles counted at once in it.
BLOCK_SETS, COLUMNS = 256, 20_000
#: Classes outside the largest component of a bucket that are joined in pairs.
FEW_OUTSIDE = 64
_WHOLE_BASE, _BAND_BASE = 0xC2B2AE3D27D4EB4F, 0x9E6C63D0876A9A35
_STEP = 0xA0761D6478BD642F


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    grams = words.grams(k)
    firsts, lasts = words.bounds[:-1], words.bounds[1:]
    whole = mixed(span_sums(words.hashes, firsts, lasts, _WHOLE_BASE) + (lasts - firsts).astype(np.uint64))
    for d, (a, b) in enumerate(zip(firsts.tolist(), lasts.tolist())):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        else:
            yield whole[d : d + min(1, b - a)]


def superminhash(elements: np.ndarray, slots: int) -> np.ndarray:
    """The signature of a non-empty set of 64-bit hashes.

    Rank j puts an element at slot p[j] with value j + u, p being the element's permutation,
    which is dealt one rank at a time. The first two ranks need no table of permutations.
    """
    signature = np.full(slots, np.inf)
    rows = np.arange(len(elements))
    swapped = order = None
    for rank in range(slots):
        random = mixed(elements + np.uint64(_STEP * (rank + 1) % 2**64))
        value = rank + (random >> np.uint64(24)).astype(np.float64) * 2.0**-40
        drawn = rank + ((random & np.uint64(0xFFFFFF)) % np.uint64(slots - rank)).astype(np.int64)
        if rank == 0:
            place = swapped = drawn
        elif rank == 1:
            place = np.where(drawn == swapped, 0, drawn)
            second = drawn
        else:
            if order is None:
                order = np.repeat(np.arange(slots, dtype=np.int32)[None], len(elements), 0)
                order[rows, swapped] = 0
                order[rows, second] = order[:, 1]
            place = order[rows, drawn]
            order[rows, drawn] = order[:, rank]
        np.minimum.at(signature, place, value)
        if signature.max() < rank + 1:
            break
    return signature


def band_keys(signature: np.ndarray, bands: int, slots: int) -> np.ndarray:
    """A hash for each band of a signature."""
    ends = np.arange(1, bands + 1) * slots
    return mixed(span_sums(signature.view(np.uint64), ends - slots, ends, _BAND_BASE) + ends.astype(np.uint64))


def signatures(docs: DataFrame, k: int, bands: int, slots: int) -> DataFrame:
    """ord, doc_id, number of shingles, a digest of the set, and the band keys."""

    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, names, keys = [], [], []
        for words in split_words(batch.column(2), NOT_SPACE, ASCII_LOWER):
            for shingles in shingle_sets(words, k):
                sizes.append(len(shingles))
                names.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                found = band_keys(superminhash(shingles, bands * slots), bands, slots) if len(shingles) else []
                keys.append(np.asarray(found, np.uint64).view(np.int64))
        arrays = [
            batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
            pa.array(keys, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["ord", "doc_id", "n_shingles", "set_key", "keys"])

    ddl = "ord long, doc_id long, n_shingles long, set_key binary, keys array<long>"
    return docs.select("ord", "doc_id", "text").mapInArrow(by_batch(lambda: sign), ddl)


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The shingles of the wanted documents: ord, shingles."""

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for words in split_words(batch.column(1), NOT_SPACE, ASCII_LOWER):
            found = [s.view(np.int64) for s in shingle_sets(words, k)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[words.first_row : words.first_row + words.n_docs], pa.array(found, pa.list_(pa.int64()))],
                ["ord", "shingles"],
            )

    chosen = docs.select("ord", "text").join(wanted, "ord", "left_semi")
    return chosen.mapInArrow(by_batch(lambda: sets), "ord long, shingles array<long>")


def _possible(a: str, b: str, percent: int) -> F.Column:
    """Whether sizes and own shingles leave room for the similarity. shared: shingles that others have too."""
    most = F.least(f"{a}.shared", f"{b}.shared")
    return 100 * most >= percent * (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles") - most)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("ord").alias("a"), F.col("shingles").alias("set_a"))
    other = sets.select(F.col("ord").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(one, "a").join(other, "b").where(100 * common >= percent * union).select("a", "b")


def links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect every component of the similarity graph. rows: key, ord, n_shingles, shared."""
    found: DataFrame | None = None
    labels: DataFrame | None = None
    # The document that the others of a bucket are compared with: the first, then one at random.
    for turn in (F.col("ord"), F.xxhash64("ord")):
        current = _labelled(rows, labels)
        leader = current.groupBy("key").agg(
            F.min(F.struct(turn.alias("turn"), "ord", "component", "n_shingles", "shared")).alias("leader"),
            F.min("component").alias("low"), F.max("component").alias("high"),
        ).where("low < high").select("key", "leader")
        pairs = (
            current.alias("x").join(leader, "key")
            .where((F.col("x.component") != F.col("leader.component")) & _possible("x", "leader", percent))
            .select(F.least("x.ord", "leader.ord").alias("a"), F.greatest("x.ord", "leader.ord").alias("b")).distinct()
        )
        new = stored(confirmed(pairs, sets, percent), "links")
        found = new if found is None else found.unionByName(new)
        labels = stored(components(found), "components")
    current = _labelled(rows, labels)
    sizes = current.groupBy("key", "component").count()
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("count", "component")).alias("largest"), F.count("*").alias("n")
    ).where("n > 1").select("key", F.col("largest.component").alias("main"))
    outside = stored(current.join(largest, "key").where("component <> main"), "outside")
    n_outside = outside.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("component").alias("n_components"))
    n_outside = stored(n_outside.where("n_components > 1"), "n_outside")
    few = outside.join(n_outside.where(F.col("n") <= FEW_OUTSIDE).select("key"), "key")
    many = outside.join(n_outside.where(F.col("n") > FEW_OUTSIDE).select("key", "n"), "key").select("key", "ord", "n")
    pairs = (
        few.alias("x").join(few.alias("y"), "key")
        .where((F.col("x.ord") < F.col("y.ord")) & (F.col("x.component") != F.col("y.component")) & _possible("x", "y", percent))
        .select(F.col("x.ord").alias("a"), F.col("y.ord").alias("b")).distinct()
    )
    among = stored(confirmed(pairs, sets, percent), "links")
    visits = outside.select(F.col("main").alias("component"), "ord").distinct()
    members = current.select("component", "ord").distinct().join(visits.select("component").distinct(), "component", "left_semi")
    if not many.isEmpty():
        among = among.unionByName(links_among(many, sets, percent))
    return found.unionByName(among).unionByName(links_to_components(visits, members, sets, percent))


def links_among(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what is similar within each key. rows: key, ord, n of the key.

    The classes of a key are dealt into blocks; two blocks, or one with itself, are one piece.
    """
    blocks = F.ceil(F.col("n") / BLOCK_SETS).cast("int")
    own, other = F.pmod(F.xxhash64("ord", F.lit("block")), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    placed = rows.select("key", "ord", own.alias("own"), other.alias("other"))
    pieces = placed.select("key", F.least("own", "other").alias("v"), F.greatest("own", "other").alias("m"), "ord")
    keys = ["key", "v", "m"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in in_groups(batches, len(keys)):
            a, b = _forest_of_piece(group, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    whole = pieces.join(sets, "ord").select(*keys, "ord", "shingles")
    return stored(whole.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long"), "links")


def _forest_of_piece(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The links of a forest that spans the similarity graph of the piece."""
    ords, shingles = group["ord"].to_numpy(), group["shingles"].combine_chunks()
    sizes = shingles.value_lengths().to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(ords)), sizes)
    names, number, times = np.unique(shingles.flatten().to_numpy(), return_inverse=True, return_counts=True)
    common = _common(doc, _columns(number, np.flatnonzero(times > 1), len(names)), int((times > 1).sum()), len(ords))
    similar = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    a, b, left = [], [], np.ones(len(ords), bool)
    for root in range(len(ords)):
        queue = [root] if left[root] else []
        left[root] = False
        while queue:
            at = queue.pop()
            near = np.flatnonzero(similar[at] & left)
            left[near] = False
            queue += near.tolist()
            a += [ords[at]] * len(near)
            b += ords[near].tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _columns(number: np.ndarray, shared: np.ndarray, n_names: int) -> np.ndarray:
    """The column of each shingle among the shared ones, or -1."""
    place = np.full(n_names, -1)
    place[shared] = np.arange(len(shared))
    return place[number]


def _common(doc: np.ndarray, column: np.ndarray, n_columns: int, n_docs: int) -> np.ndarray:
    """How many of the columns every two documents share."""
    common = np.zeros((n_docs, n_docs), np.float32)
    for at in range(0, n_columns, COLUMNS):
        some = np.flatnonzero((column >= at) & (column < at + COLUMNS))
        table = np.zeros((n_docs, min(COLUMNS, n_columns - at)), np.float32)
        table[doc[some], column[some] - at] = 1
        common += table @ table.T
    return common.astype(np.int64)


def links_to_components(visits: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a link to a component for each class that visits it and has one. Both: component, ord.

    Visitors and members of a component are dealt into blocks; a block of either kind is one piece.
    """
    sizes = (
        visits.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("v_blocks"))
        .join(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("m_blocks")), "component")
    )

    def dealt(rows: DataFrame, own: str, other: str, member: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("ord", F.lit("block")), F.col(own)).cast("int").alias(own[0])
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])
        placed = rows.join(sizes, "component").select("component", "ord", mine, every)
        return placed.select("component", "v", "m", "ord", F.lit(member).alias("member"))

    pieces = dealt(visits, "v_blocks", "m_blocks", False).unionByName(dealt(members, "m_blocks", "v_blocks", True))
    keys = ["component", "v", "m"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in in_groups(batches, len(keys)):
            a, b = _links_in_piece(group, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    whole = pieces.join(sets, "ord").select(*keys, "ord", "member", "shingles")
    return stored(whole.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long"), "links")


def _links_in_piece(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each visitor that is similar enough to some member: the two."""
    ords, member = group["ord"].to_numpy(), group["member"].to_numpy(zero_copy_only=False)
    shingles = group["shingles"].combine_chunks()
    sizes = shingles.value_lengths().to_numpy().astype(np.int64)
    doc, values = np.repeat(np.arange(len(ords)), sizes), shingles.flatten().to_numpy()
    names, number = np.unique(values, return_inverse=True)
    of_member = member[doc]
    both = np.zeros(len(names), np.int8)
    both[number[of_member]] |= 1
    both[number[~of_member]] |= 2
    shared = np.flatnonzero(both == 3)
    common = _common(doc, _columns(number, shared, len(names)), len(shared), len(ords))
    visitors, members = np.flatnonzero(~member), np.flatnonzero(member)
    inside = common[np.ix_(visitors, members)]
    similar = 100 * inside >= percent * (sizes[visitors][:, None] + sizes[members][None, :] - inside)
    similar &= ords[visitors][:, None] != ords[members][None, :]
    linked = np.flatnonzero(similar.any(1)) if similar.size else np.zeros(0, np.int64)
    return ords[visitors[linked]], ords[members[similar[linked].argmax(1)]] if len(linked) else ords[:0]


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("component", F.col("ord"))
    named = labels.select(F.col("node").alias("ord"), F.col("component").alias("named"))
    return rows.join(named, "ord", "left").withColumn("component", F.coalesce("named", "ord")).drop("named")


def near_duplicates(
    documents: DataFrame, k: int = SHINGLE_WORDS, percent: int = 75, bands: int = BANDS, slots: int = BAND_SLOTS
) -> DataFrame:
    """Of each document: ord, doc_id, n_shingles, component_id and whether it is the one kept of its component."""
    return near_duplicates_in(ordered(documents), k, percent, bands, slots)


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows of documents, one for each component."""
    docs = ordered(documents, whole=True)
    gone = near_duplicates_in(docs.select("ord", "doc_id", "text")).where(~F.col("kept")).select("ord")
    return docs.join(stored(gone, "gone"), "ord", "left_anti").select("row.*")


def near_duplicates_in(
    docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = 75, bands: int = BANDS, slots: int = BAND_SLOTS
) -> DataFrame:
    """As near_duplicates, of documents in order (ord, doc_id, text)."""
    signed = stored(signatures(docs, k, bands, slots), "signatures")
    classes = signed.where("n_shingles > 0").groupBy("set_key").agg(F.min("ord").alias("class"))
    first_of_set = signed.join(classes.select(F.col("class").alias("ord")), "ord", "left_semi")
    banded = first_of_set.select(F.explode("keys").alias("key"), "ord", "n_shingles")
    met = banded.groupBy("key").count().where("count > 1").select("key")
    rows = stored(banded.join(met, "key"), "banded")

    sets = stored(full_sets(docs, rows.select("ord").distinct(), k), "sets")
    single = sets.select("ord", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("ord").alias("ord")
    ).where("n = 1")
    own = single.groupBy("ord").agg(F.count("*").alias("own"))
    possible = (
        rows.select("ord", "n_shingles").distinct().join(own, "ord", "left")
        .withColumn("shared", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
        .where(100 * F.col("shared") >= percent * F.col("n_shingles")).select("ord", "shared")
    )
    rows = stored(rows.join(possible, "ord"), "possible")
    sets = stored(sets.join(possible.select("ord"), "ord", "left_semi"), "sets")

    joined = components(links(rows, sets, percent))
    named = joined.join(signed.select(F.col("ord").alias("component"), F.col("doc_id").alias("component_id")), "component")
    placed = (
        signed.drop("keys").join(classes, "set_key", "left")
        .join(named.withColumnRenamed("node", "class"), "class", "left")
        .join(signed.select(F.col("ord").alias("class"), F.col("doc_id").alias("class_id")), "class", "left")
    )
    first = F.coalesce("component", "class", "ord")
    return placed.select(
        "ord", "doc_id", "n_shingles",
        F.when(F.col("component").isNotNull(), F.col("component_id")).when(F.col("class").isNotNull(), F.col("class_id"))
        .otherwise(F.col("doc_id")).alias("component_id"),
        (F.col("ord") == first).alias("kept"),
    )
