"""Conversation prefixes as double-array tries, one per shard of the sorted conversations.

Conversations are rebuilt, those with the same turns folded into one, and the rest cut into
ranges of their order by turns: a range is one shard of the prefix tree. A shard numbers its
turns densely, packs its trie into BASE and CHECK arrays and walks all conversations through it.
A node can stand in two shards only if it lies on the way to a shard's first or last
conversation, since all conversations below a node are neighbours in that order. These few nodes
are merged over all shards; everything below them is already whole.

Turns count as equal if role, text and the first 128 bits of SHA-256 over both are. Null roles and
texts are empty ones. Turns of one number are taken in the order of their digests; a repeated row
is a repeated turn. Rows without conv_id belong to no conversation. An empty table gives no nodes,
any other has a root. Five conversations that are rebuilt from one must fit into a task, and so
must those that agree in their first 64 turns and differ later.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import stored

#: A turn is 16 bytes of its digest and 8 of its text's length.
DIGEST_BYTES, TURN_BYTES = 16, 24
#: Turns that decide on the shard of a conversation.
SHARD_TURNS = 64
#: Ids of one conversation text that travel as one row are of the same so many numbers.
ID_BITS = 10
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Shared nodes are broadcast up to this size, at so many bytes a node.
BROADCAST_BYTES, NODE_BYTES = 64 << 20, 64
FREE, ROOT = -2, -1

NODE = (
    "key binary, ancestors array<binary>, parent_key binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, text_bytes long, ends_sha256 string"
)


class DoubleArray:
    """A trie over dense symbols: the child of slot s by symbol c is t = base[s] + c if check[t] == s."""

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray):
        """Packs sequences in sorted order; sequence i is symbols[offsets[i] : offsets[i + 1]]."""
        self.symbols, self.offsets = symbols, offsets
        size = len(symbols) + 16
        self.base, self.check = np.zeros(size, np.int64), np.full(size, FREE, np.int64)
        self.check[0] = ROOT
        self.first_free, self.probe = 1, 1
        #: New slots of each depth from 1 on.
        self.levels: list[np.ndarray] = []
        slots, lengths = np.zeros(len(offsets) - 1, np.int64), np.diff(offsets)
        for depth in range(int(lengths.max(initial=0))):
            active = np.flatnonzero(lengths > depth)
            parents, symbol = slots[active], symbols[offsets[active] + depth]
            new = np.append(True, (parents[1:] != parents[:-1]) | (symbol[1:] != symbol[:-1]))
            found = self._placed(parents[new], symbol[new])
            slots[active] = found[np.cumsum(new) - 1]
            self.levels.append(found)

    def _placed(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Slots for the children of one depth; children of a parent are neighbours."""
        starts = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        counts = np.diff(np.append(starts, len(parents)))
        found = np.empty(len(parents), np.int64)
        for at, n in zip(starts[counts > 1], counts[counts > 1]):
            mine = symbols[at : at + n]
            base = self._fitting(mine)
            found[at : at + n] = base + mine
            self.base[parents[at]] = base
            self.check[base + mine] = parents[at]
        # A single child fits anywhere.
        single = starts[counts == 1]
        found[single] = self._free(len(single))
        self.base[parents[single]] = found[single] - symbols[single]
        self.check[found[single]] = parents[single]
        return found

    def _fitting(self, symbols: np.ndarray) -> int:
        """A base that puts all symbols on free slots."""
        shifts = symbols - symbols.min()
        for start in (self.first_free, self.probe):
            near = start + np.flatnonzero(self.check[start : start + 64] == FREE)
            for slot in near[near + shifts.max() < len(self.check)]:
                if (self.check[slot + shifts] == FREE).all():
                    self.probe = int(slot)
                    return int(slot - symbols.min())
        end = int(np.flatnonzero(self.check != FREE)[-1]) + 1
        self._grow(end + int(shifts.max()) + 1)
        self.probe = end
        return end - int(symbols.min())

    def _free(self, n: int) -> np.ndarray:
        found = self.first_free + np.flatnonzero(self.check[self.first_free :] == FREE)
        if len(found) < n:
            self._grow(len(self.check) + n)
            return self._free(n)
        if n:
            self.first_free = int(found[n - 1]) + 1
        return found[:n]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, len(self.check) * 5 // 4) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, FREE, np.int64))

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, sequences that are as long, their slots), from the root on."""
        lengths = np.diff(self.offsets)
        active = np.arange(len(lengths))
        slots = np.zeros(len(lengths), np.int64)
        yield 0, active, slots
        for depth in range(len(self.levels)):
            longer = lengths[active] > depth
            active, slots = active[longer], slots[longer]
            children = self.base[slots] + self.symbols[self.offsets[active] + depth]
            if (self.check[children] != slots).any():
                raise AssertionError("a sequence has left the trie")
            slots = children
            yield depth + 1, active, slots


def rebuilt(conversations: DataFrame, head_turns: Column, family: int = 5, longest_head: int = 8) -> DataFrame:
    """conv_id and ``path`` (its rebuilt turns, 24 bytes each) of every conversation.

    The head, of head_turns turns and longest_head at most, comes from the conversation whose id is
    the next lower multiple of family (towards zero).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    length = F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * (TURN_BYTES - DIGEST_BYTES), "0")
    turn = F.unhex(F.concat(F.substring(F.sha2(both, 256), 1, 2 * DIGEST_BYTES), length))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("known"),
            F.col("turn").alias("turn"), turn.alias("content"),
        ).alias("turn"),
    )
    families = turns.groupBy((F.col("conv_id") - F.col("conv_id") % family).alias("first")).agg(
        F.array_sort(F.collect_list("turn")).alias("turns")
    )
    members = families.select("first", "turns", F.explode(F.array_distinct("turns.conv_id")).alias("conv_id"))

    def turns_of(name: str) -> Column:
        mine = F.filter("turns", lambda t: t["conv_id"] == F.col(name))
        return F.transform(mine, lambda t: F.hex(t["content"]))

    members = members.select("conv_id", head_turns.cast("int").alias("head"), turns_of("first").alias("theirs"), turns_of("conv_id").alias("own"))
    head = F.slice("theirs", F.lit(1), F.least("head", F.lit(longest_head)))
    tail = F.slice("own", F.col("head") + 1, F.greatest(F.size("own"), F.lit(1)))
    return members.select("conv_id", F.unhex(F.array_join(F.concat(head, tail), "")).alias("path"))


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard from (path, ids) rows, sorted by path and then by ids."""
    paths, counts, least, ends, digest = [], [], [], [], None
    for batch in batches:
        for path, ids in zip(batch.column(0), batch.column(1)):
            path, ids = path.as_py(), ids.values.to_numpy()
            text = ",".join(map(str, ids.tolist())).encode()
            if paths and paths[-1] == path:
                counts[-1] += len(ids)
                least[-1] = min(least[-1], int(ids[0]))
                digest.update(b"," + text)
            else:
                if paths:
                    ends.append(digest.hexdigest())
                paths.append(path)
                counts.append(len(ids))
                least.append(int(ids[0]))
                digest = hashlib.sha256(text)
    if not paths:
        return
    ends.append(digest.hexdigest())
    yield from _nodes(paths, np.array(counts), np.array(least), np.array(ends))


def _nodes(paths: list[bytes], counts: np.ndarray, least: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    offsets = np.append(0, np.cumsum([len(p) // TURN_BYTES for p in paths]))
    elements = np.frombuffer(b"".join(paths), f"V{TURN_BYTES}")
    symbols, text_bytes = _dense(elements, offsets)
    trie = DoubleArray(symbols, offsets)
    size = len(trie.check)
    n_convs, conv_id = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depths, last, end = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1)
    edges = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for depth, active, slots in trie.walk():
        np.add.at(n_convs, slots, counts[active])
        np.minimum.at(conv_id, slots, least[active])
        depths[slots] = depth
        if depth:
            last[slots] = symbols[offsets[active] + depth - 1]
        done = np.diff(offsets)[active] == depth
        end[slots[done]] = active[done]
        for edge, sequence in zip(edges, (0, len(paths) - 1)):
            if depth and active.size and active[0 if not sequence else -1] == sequence:
                edge.append(slots[[0 if not sequence else -1]])
    shared = np.zeros(size, bool)
    for edge in edges:
        shared[np.concatenate(edge)] = True
    own_bytes = np.append(text_bytes, 0)[last]
    children = np.zeros(size, np.int64)
    for level in trie.levels:
        np.add.at(children, trie.check[level[~shared[level]]], 1)
    leaves = np.where(shared, 0, children == 0)
    saved = np.where(shared, 0, (n_convs - 1) * own_bytes)
    for level in reversed(trie.levels):
        whole = level[~shared[level]]
        np.add.at(leaves, trie.check[whole], leaves[whole])
        np.add.at(saved, trie.check[whole], saved[whole])

    keys = {}
    for edge, path in zip(edges, (paths[0], paths[-1])):
        above = []
        for slot in np.concatenate(edge).tolist():
            key = hashlib.blake2b(path[: TURN_BYTES * len(above)], digest_size=16).digest()
            keys[slot] = key, list(above)
            above.append(key)
    slots = np.concatenate([np.zeros(1, np.int64), *trie.levels])
    for at in range(0, len(slots), 8_192):
        part = slots[at : at + 8_192]
        parents = trie.check[part]
        inner = ~shared[part] & ~shared[parents] & (parents >= 0)
        below = ~shared[part] & shared[parents]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[s][0] if s in keys else None for s in part.tolist()], pa.binary()),
                pa.array([keys[s][1] if s in keys else None for s in part.tolist()], pa.list_(pa.binary())),
                pa.array([keys[p][0] if b else None for p, b in zip(parents.tolist(), below)], pa.binary()),
                pa.array(conv_id[part]), pa.array(depths[part]),
                pa.array(conv_id[parents], mask=~inner),
                pa.array(n_convs[part]), pa.array(children[part]), pa.array(leaves[part]), pa.array(saved[part]),
                pa.array(own_bytes[part]),
                pa.array(ends[end[part]], pa.string(), mask=end[part] < 0),
            ],
            [field.split()[0] for field in NODE.split(", ")],
        )


def _dense(elements: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ids of turns, numbered by depth and place of their first occurrence, so that siblings lie close; and
    the text bytes of each id."""
    if not len(elements):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.diff(offsets)
    depth = np.arange(len(elements)) - np.repeat(offsets[:-1], lengths)
    by_depth = np.argsort(depth, kind="stable")
    values, first, number = np.unique(elements[by_depth], return_index=True, return_inverse=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(first)] = np.arange(len(values))
    symbols = np.empty(len(elements), np.int64)
    symbols[by_depth] = rank[number]
    length = np.frombuffer(values.tobytes(), np.uint8).reshape(-1, TURN_BYTES)[:, DIGEST_BYTES:]
    text_bytes = np.empty(len(values), np.int64)
    text_bytes[rank] = np.ascontiguousarray(length).view(">i8").ravel()
    return symbols, text_bytes


def _merged(shared: DataFrame) -> DataFrame:
    """The nodes of more than one shard: their parts added up, then what lies below them."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = stored(
        shared.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.first("ancestors").alias("ancestors"),
            *sums, F.max("text_bytes").alias("text_bytes"), F.max("ends_sha256").alias("ends_sha256"),
        ),
        "shared-nodes",
    )
    parent = F.try_element_at("ancestors", F.lit(-1))
    shared_children = nodes.where("depth > 0").groupBy(parent.alias("key")).agg(F.count(F.lit(1)).alias("more"))
    nodes = nodes.join(shared_children, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    ).withColumn("parent_key", parent)
    leaves = F.col("n_leaves") + (F.col("n_children") == 0).cast("long")
    saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("text_bytes")
    below = nodes.select(
        F.explode(F.concat("ancestors", F.array("key"))).alias("key"), leaves.alias("leaves"), saved.alias("saved")
    ).groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.drop("n_leaves", "saved_tokens", "ancestors", "text_bytes").join(below, "key").join(parents, "parent_key", "left")


def prefix_nodes(conversations: DataFrame, head_turns: Column) -> DataFrame:
    """A row per node of the prefix tree of the rebuilt conversations; see rebuilt for head_turns."""
    found = rebuilt(conversations, head_turns)
    # A conversation of many copies comes in rows of up to 1,024 ids.
    folded = found.groupBy("path", F.shiftright("conv_id", ID_BITS).alias("ids_from")).agg(
        F.array_sort(F.collect_list("conv_id")).alias("ids")
    )
    shards = folded.repartitionByRange(F.substring("path", 1, SHARD_TURNS * TURN_BYTES)).sortWithinPartitions("path", "ids_from")
    nodes = stored(shards.select("path", "ids").mapInArrow(_shard_nodes, NODE), "trie")
    merged = stored(_merged(nodes.where("key IS NOT NULL")), "merged")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    # Two nodes a depth and shard at most.
    if merged.count() * NODE_BYTES <= BROADCAST_BYTES:
        parents = F.broadcast(parents)
    inner = nodes.where("key IS NULL")
    below = inner.where("parent_key IS NOT NULL").join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("found"))
    whole = (
        inner.where("parent_key IS NULL").select(*columns).unionByName(below.select(*columns))
        .unionByName(merged.select(*columns))
    )
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))
