"""Collocations, prefix tries and the compression classifier against plain versions, with all odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from helpers_llm import text_of
from pyspark.sql import functions as F

from pitwall.llm import collocation, compression, trie
from pitwall.llm.tables import checksum32


# Collocations


def plain_collocations(rows, least, most):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    result = []
    for lang, found in counts.items():
        frequent = {p: f for p, f in found.items() if len(p) > 1 and f >= least}
        inside = {
            p[i:j]: True
            for p, f in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * f >= 100 * found[p[i:j]]
        }
        ranked = []
        for p, a in frequent.items():
            if p not in inside:
                cuts = [(1000 * a * total[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(result)


def collocation_rows(seed):
    rng = random.Random(seed)
    names = [text_of(rng, k) for k in (2, 3, 4, 5)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([*names, text_of(rng, rng.randint(1, 6)), "New  York", "new\tyork", "a a a a"]) for _ in range(12)]
        texts.append("".join(p + rng.choice([" ", ", ", ".\n", "! ", "\x0b", " - "]) for p in parts))
    texts += [None, "", " ", ".,;", "\r\n", "é é é é " * 9, "tie one. tie two. " * 6, "x y. X Y; x y, " * 3]
    langs = ["en", "fr", None, "und", ""]
    rows = [(t, rng.choice(langs)) for t in texts]
    return rows + rows[:20] + [("long " + "word pair " * 4000, "en")]


@pytest.mark.parametrize("seed, least, most", [(1, 8, 2000), (2, 20, 5), (3, 3, 40)])
def test_collocations(spark, seed, least, most):
    rows = collocation_rows(seed)
    docs = spark.createDataFrame([(t, lang, "x", 1.0) for t, lang in rows], "text string, lang string, phrase string, n double")
    found = collocation.collocations(docs.repartition(5), least, most)
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, least, most)
    assert [kind for _, kind in found.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocation.collocations(docs).isEmpty()
    docs = spark.createDataFrame([(None, None), ("", "en"), (". ,", "en")], "text string, lang string")
    assert collocation.collocations(docs, 1).isEmpty()


def test_collocations_with_small_tables_in_tasks(spark, monkeypatch):
    """Many packed rows, summaries that subtract and grow, and a filter in which most bits are set."""
    for name, value in {"HELD": 64, "SUMMARY": 4, "SLACK": 1, "FILTER_BITS": 1 << 12}.items():
        monkeypatch.setattr(collocation, name, value)
    monkeypatch.setattr(collocation, "LEAST_PARTS", 4)
    monkeypatch.setattr(collocation, "MOST_PARTS", 64)
    rows = collocation_rows(4)[:40]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = collocation.collocations(docs, 10, 500)
    assert sorted(tuple(r) for r in found.collect()) == plain_collocations(rows, 10, 500)


def test_summaries_lose_nothing_frequent():
    """Over any order of additions, also merged, errors stay below the least count."""
    rng = np.random.default_rng(3)
    values = np.minimum(rng.zipf(1.3, 60_000), 30_000).astype(np.uint64)
    counts, least = Counter(values.tolist()), 100
    for capacity in (1, 50, 2 * len(values) // least):
        halves = [collocation.MisraGries(capacity, least), collocation.MisraGries(capacity, least)]
        for i, part in enumerate(np.array_split(rng.permutation(values), 40)):
            found, times = np.unique(part, return_counts=True)
            halves[i % 2].add(found, times)
        first, second = halves
        frequent = {v for v, n in counts.items() if n >= least}
        for half in halves:
            assert half.error < least and len(half.hashes) <= half.capacity
        whole = collocation.MisraGries(capacity, least)
        for part in np.array_split(values, 40):
            found, times = np.unique(part, return_counts=True)
            whole.add(found, times)
        assert frequent <= set(whole.survivors().tolist())
        estimates = dict(zip(whole.hashes.tolist(), whole.counts.tolist()))
        assert all(n - whole.error <= estimates.get(v, 0) <= n for v, n in counts.items())


# Prefix tries


def plain_nodes(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[conv_id].append(((turn is not None, turn or 0), digest, (role, text)))
    turns = {c: [t for _, _, t in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(lambda: ([], []))
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5 if c > 0 else -(abs(c) % 5))
        path = tuple(turns.get(first, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]][0].append(c)
        nodes[path][1].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = Counter(), Counter()
    for path in nodes:
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(nodes[path][0]) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted(
        (
            min(members), len(path), min(nodes[path[:-1]][0]) if path else None, len(members), len(children[path]),
            leaves[path], saved[path], hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest(),
        )
        for path, (members, ends) in nodes.items()
    )


def sorted_nodes(spark, rows, partitions=7):
    talks = spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = trie.prefix_nodes(talks, checksum32("conv_id") % 9)
        result = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    assert {kind for _, kind in found.dtypes} == {"bigint", "string"}
    return sorted(result, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_prefix_nodes(spark, seed):
    rng = random.Random(seed)
    hello = [(k, rng.choice(["user", None]), text_of(rng, 3)) for k in range(6)]
    rows = []
    for c in rng.sample(range(-40, 400), 150):
        n = rng.randint(1, 12)
        common = rng.randint(0, 6)
        talk = hello[:common] + [(k, rng.choice(["user", "assistant"]), rng.choice(["yes", "no", "é", "", None])) for k in range(common, n)]
        rows += [(c, *t) for t in talk]
    rows += [(c, k, "user", f"turn {k}") for c in range(1000, 1200) for k in range(5)]
    rows += [(7000, k, "user", str(k)) for k in range(700)] + [(7005, k, "user", str(k)) for k in range(650)]
    rows += [(None, 1, "user", "nobody"), (2000, None, "user", "null first"), (2000, 0, "user", "then"), (2000, 0, "user", "then")]
    rows += [(2000, 0, None, "tie"), (2000, -3, "", None)]
    rng.shuffle(rows)
    key = lambda r: (r[0], r[1], r[2] is not None, r[2] or 0)
    assert sorted_nodes(spark, rows) == sorted(plain_nodes(rows), key=key)


def test_prefix_nodes_of_little(spark):
    assert sorted_nodes(spark, []) == []
    assert sorted_nodes(spark, [(None, 1, "a", "b")]) == []
    # Conversation 7 has two turns, and its head would come from conversation 5, which there is not.
    rows = [(7, 0, "a", "b"), (7, 1, "a", "c")]
    assert zlib.crc32(b"7") % 9 >= 2
    assert sorted_nodes(spark, rows) == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


def test_double_arrays_hold_exactly_their_sequences():
    rng = random.Random(5)
    for size in (1, 3, 50):
        some = sorted({tuple(rng.randrange(size) for _ in range(rng.randint(0, 9))) for _ in range(300)})
        offsets = np.append(0, np.cumsum([len(s) for s in some]))
        array = trie.DoubleArray(np.array([c for s in some for c in s], np.int64), offsets)
        prefixes = {s[:d] for s in some for d in range(len(s) + 1)}
        slots = np.concatenate([[0], *array.levels])
        assert len(slots) == len(set(slots.tolist())) == len(prefixes)
        assert (array.check[slots[1:]] >= 0).all()
        assert len(array.check) < 20 * (len(prefixes) + size) + 100
        for prefix in prefixes:
            slot = 0
            for symbol in prefix:
                child = array.base[slot] + symbol
                assert array.check[child] == slot
                slot = child


# Quality by compression


def quality_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = text_of(rng, rng.randint(20, 120))
        good = rng.random() < 0.8
        if not good:
            text = rng.choice([lambda t: "!! ".join(t.upper().split()), lambda t: " | ".join(t.split()), lambda t: " ".join(t.split()[:2] * 40)])(text)
        rows.append((i, text, int(good)))
    return rows


def labelled(spark, rows):
    documents = spark.createDataFrame([(i, t, 9.0, "x") for i, t, _ in rows], "doc_id long, text string, score double, good string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    return documents, labels


def test_compression_scores_are_those_of_plain_code(spark):
    rows = quality_rows(1)
    documents, labels = labelled(spark, rows)
    unseen = F.coalesce(checksum32("doc_id") % 5 == 0, F.lit(False))
    model = compression.trained(documents, labels, learn_from=~unseen)
    odd = [(None, None), (None, "a"), (7, ""), (7, ""), (7, "é" * 400), (1, rows[1][1]), (1, text_of(random.Random(3), 20_000))]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    found = compression.scored(docs, model).collect()
    assert len(found) == len(rows) + len(odd)

    def size(block, dictionary):
        engine = zstandard.ZstdCompressor(
            level=compression.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
            write_checksum=False, write_dict_id=False,
        )
        return len(engine.compress(block))

    for r in found:
        data = (r.text or "").encode()
        blocks = [data[i : i + 256] for i in range(0, len(data), 256)]
        difference = sum(size(b, model.bad) - size(b, model.good) for b in blocks) / max(1, len(data))
        assert abs(r.score - 1 / (1 + np.exp(-(model.slope * difference + model.offset)))) < 1e-9
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    right = {i: q for i, _, q in rows}
    held = [r for r in found if r.doc_id in right and r.text == rows[r.doc_id][1] and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and np.mean([r.predicted == right[r.doc_id] for r in held]) > 0.95


def test_compression_without_labels_of_both_kinds(spark):
    documents, labels = labelled(spark, quality_rows(2, 30))
    for some in (labels.where("quality = 1"), labels.where("false"), labels.withColumn("quality", F.lit(None).cast("int"))):
        model = compression.trained(documents, some, learn_from=F.lit(True))
        assert {(r.score, r.predicted) for r in compression.scored(documents.drop("score"), model).collect()} == {(0.5, 1)}
    nothing = compression.scored(documents.drop("score").where("false"), compression.Model())
    assert nothing.isEmpty()
    assert compression.trained(documents.where("false"), labels, learn_from=F.lit(True)) == compression.Model()


def test_compression_learns_from_repeated_and_clashing_rows(spark):
    """One document on most rows, labelled over and over, and one with both labels."""
    rows = quality_rows(3, 200)
    many = rows + [(5, rows[5][1], rows[5][2])] * 300 + [(6, rows[6][1], 0), (6, rows[6][1], 1), (None, "x", 1)]
    documents, labels = labelled(spark, many)
    model = compression.trained(documents, labels, learn_from=F.lit(True), sample_documents=50)
    scores = compression.scored(documents.drop("score"), model).collect()
    assert len(scores) == len(many)
    assert np.mean([int(r.predicted) == q for r, q in zip(sorted(scores, key=lambda r: (r.doc_id is None, r.doc_id or 0)), [q for _, _, q in sorted(many, key=lambda m: (m[0] is None, m[0] or 0))])]) > 0.9
