"""Edge cases of every operator, against plain versions: nulls, empty and long texts, ties, repeats, empty tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import text_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitwall.llm import components, langid, lattice, minhash, packing, pages, repeats, token_files, toxicity, warc, winnow
from pitwall.llm.encoding import Encoder
from pitwall.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER
from pitwall.llm.words import ASCII_LOWER, NOT_SPACE, letter_words, split_words

ODD_TEXTS = [
    "", " ", "a  b", " a", "a ", "\n", "a\n\nb c", "a\tb", "a\t\tb   c", "don't 's", "x<|endoftext|> y", "é ́",
    "1234 56,7", "a \n b", "a\x1cb", "a\x0bb", "\x85q r", "İstanbul", "Straße!", "你好 w", "a <|end b", " ",
]


def mixture(seed):
    """Texts with copies, near copies, shared passages, odd and long ones; ids with nulls and repeats."""
    rng = random.Random(seed)
    base, passage = text_of(rng, 120), text_of(rng, 30)
    texts = [text_of(rng, rng.randint(1, 80)) for _ in range(25)] + [base] * 6 + [None, ""] + ODD_TEXTS
    for _ in range(12):
        words = base.split()
        words[rng.randrange(len(words))] = "new" + str(rng.random())[2:6]
        texts.append(" ".join(words))
    texts += [f"{text_of(rng, 20)} {passage} {text_of(rng, 15)}" for _ in range(8)]
    texts += [" ".join(["same"] * 60), " ".join([text_of(rng, 21)] * 3), text_of(rng, 3000), text_of(rng, 4), "one"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [*zip(ids, texts), (None, base), (None, None), (3, base), (3, text_of(rng, 25))]


def order_of(rows):
    """The rows in order of id and text, nulls first, which names documents by their number."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_words_are_those_of_a_regular_expression():
    rng = random.Random(1)
    texts = [None, *ODD_TEXTS, text_of(rng, 500), "été ÉTÉ AÄ"]
    for is_lower in (False, True):
        for words in split_words(pa.array(texts), NOT_SPACE, ASCII_LOWER if is_lower else None):
            for d in range(words.n_docs):
                text = texts[words.first_row + d] or ""
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text) if is_lower else text
                a, b = words.bounds[d : d + 2]
                found = [bytes(words.data[s:e]).decode() for s, e in zip(words.starts[a:b], words.ends[a:b])]
                assert found == [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


@pytest.mark.parametrize("path, spaces", [(BYTE_TOKENIZER, "kept"), (WORD_TOKENIZER, "dropped")])
def test_ids_equal_the_library(path, spaces):
    encoder, tokenizer, rng = Encoder(path, spaces), Tokenizer.from_file(path), random.Random(2)
    letters = "aBé ñ\n\t .,'1ß ́*|<"
    texts = ODD_TEXTS + [text_of(rng, 50)] * 2 + ["".join(rng.choice(letters) for _ in range(40)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def brute_repeats(rows, k):
    seen, out = {}, []
    for number, (doc_id, text) in enumerate(order_of(rows)):
        words, gone = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w], set()
        for at in range(len(words) - k + 1):
            if seen.setdefault(tuple(words[at : at + k]), (number, at)) != (number, at):
                gone.update(range(at, at + k))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, documents, seed):
    rows = mixture(seed)
    found = repeats.without_repeats(documents(rows), k=20)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.orderBy("ord").collect()]
    assert sorted(got, key=repr) == sorted(brute_repeats(rows, 20), key=repr)
    assert repeats.without_repeats(documents([])).isEmpty()
    unique = [(i, t) for i, (_, t) in enumerate(rows)]
    again = {r.doc_id: r for r in repeats.rewritten(documents(unique), k=20).collect()}
    by_id = {r[0]: r for r in brute_repeats(unique, 20)}
    for i, text in unique:
        expected = text if not by_id[i][2] else None
        assert expected is None or again[i].text == expected
        assert expected is not None or text is None or hashlib.sha256(again[i].text.encode()).hexdigest() == by_id[i][3]
        assert again[i].ord == "x"


def shingles(text, k=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[a : a + k]) for a in range(max(1, len(words) - k + 1))} if words else set()


def brute_near(rows):
    docs = order_of(rows)
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(docs[i][0], len(sets[i]), docs[find(i)][0], find(i) == i) for i in range(len(docs))]


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates(spark, documents, seed):
    rows = mixture(seed)
    found = minhash.near_duplicates(documents(rows)).orderBy("ord").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found] == brute_near(rows)
    assert minhash.near_duplicates(documents([])).isEmpty()
    kept = minhash.deduplicated(documents(rows)).collect()
    assert len(kept) == sum(r.kept for r in found) and kept[0].ord == "x"


def test_near_copies_with_a_chain_and_outsiders(spark, documents):
    """A group in which not all are similar to each other, and members that only one of them links."""
    rng = random.Random(9)
    words, rows = text_of(rng, 200).split(), []
    for i in range(60):
        if i % 3 == 0:
            words = [text_of(rng, 1) if rng.random() < 0.02 else w for w in words]
        rows.append((i, " ".join(text_of(rng, 1) if rng.random() < 0.015 * (i % 4) else w for w in words)))
    found = minhash.near_duplicates(documents(rows)).orderBy("ord").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found] == brute_near(rows)


def test_many_classes_outside_are_compared_in_blocks(spark, documents, monkeypatch):
    rng = random.Random(31)
    monkeypatch.setattr(minhash, "FEW_OUTSIDE", 1)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 4)
    sets, chain = [], text_of(rng, 60).split()
    for i in range(60):  # unlike others, pairs, and a chain of likes
        chain[i % 60] = f"new{i}"
        sets.append(" ".join(chain) if i % 3 else text_of(rng, 40))
    docs = [(i, sets[i]) for i in rng.sample(range(60), 60)]
    df = documents(docs).selectExpr("doc_id AS ord", "text")
    full = minhash.full_sets(df, df.select("ord"), 5)
    rows = df.selectExpr("7L AS key", "ord", "60L AS n")
    joined = components.components(minhash.links_among(rows, full, 75))
    found = {r.node: r.component for r in joined.collect()}
    own = {i: shingles(text) for i, text in docs}
    label = {i: i for i in own}
    for _ in own:
        for i in own:
            label[i] = min(label[j] for j in own if 4 * len(own[i] & own[j]) >= 3 * len(own[i] | own[j]))
    assert {i: found.get(i, i) for i in own} == label and len(set(label.values())) < 60
    found = minhash.near_duplicates(documents(docs)).orderBy("ord").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found] == brute_near(docs)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    for n, expected in ((3, 0.5), (40, 0.75), (500, 0.75)):
        errors = []
        for _ in range(30):
            common = rng.integers(0, 2**63, round(n * 2 * expected / (1 + expected)) or 1, dtype=np.uint64)
            a, b = (np.append(common, rng.integers(0, 2**63, n - len(common), dtype=np.uint64)) for _ in range(2))
            true = len(common) / (2 * n - len(common))
            same = minhash.superminhash(a, 160) == minhash.superminhash(b, 160)
            errors.append(same.mean() - true)
        assert abs(np.mean(errors)) < 0.03


def test_components(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    edges += [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)]
    rng.shuffle(edges)
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    expected = label
    for limit in (500_000, 10):
        monkeypatch.setattr(components, "TASK_EDGES", limit)
        df = spark.createDataFrame(edges, "a long, b long").repartition(8)
        assert dict(components.components(df).collect()) == expected
    assert components.components(df.limit(0)).isEmpty()


def brute_links(rows):
    units = []
    for _, e, label in rows:
        e = np.array([np.nan if x is None else x for x in e or []], float)
        usable = label is not None and len(e) and np.isfinite(e).all() and e.any()
        units.append(e / np.linalg.norm(e) if usable else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(n)]
    return [(rows[i][0], len(near[i]), rows[label[i]][0], label[i] == i) for i in range(n)]


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(7)
    centres, rows = rng.standard_normal((6, 64)), []
    for i in range(150):
        rows.append((i, (centres[i % 6] + rng.standard_normal(64) * rng.choice([0.05, 0.2])).tolist(), i % 2))
    rows += [(200 + i, rows[0][1], rows[0][2]) for i in range(20)] + [(300, rows[0][1], None), (301, None, 1), (302, [], 1)]
    rows += [(303, [0.0] * 64, 1), (304, [None] * 64, 1), (305, [float("nan")] * 64, 1), (306, [1.0, 2.0], 1), (307, [1.0, 2.0], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, ord int")
    rows = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], la) for i, e, la in rows]
    for block in (256, 7):
        found = lattice.linked
        monkeypatch.setattr(lattice, "linked", lambda c, t, found=found, block=block: found(c, t, block_rows=block))
        result = lattice.near_duplicate_vectors(df).orderBy("ord").collect()
        assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in result] == brute_links(rows)
        monkeypatch.setattr(lattice, "linked", found)
    assert lattice.near_duplicate_vectors(df.limit(0)).isEmpty()


@pytest.mark.parametrize("size, share", [(16, 1.0), (128, 1.0), (128, 0.05)])
def test_recall_of_vector_pairs_at_the_threshold(spark, size, share):
    """600 pairs of unrelated directions at cosines of 0.9305 to 0.95, the length in all components or in few; recall 0.99 at least."""
    rng = np.random.default_rng(size)
    scale = np.where(np.arange(size) < max(6, size * share), 1.0, 0.02)
    rows = []
    for i in range(600):
        a, b = rng.standard_normal((2, size)) * scale
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        cosine = rng.uniform(0.9305, 0.95)
        rows += [(2 * i, a.tolist(), i), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)).tolist(), i)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = lattice.near_duplicate_vectors(df).where("n_links = 1 AND NOT kept").count()
    assert found >= 594


def test_nearest_lattice_point():
    points = np.random.default_rng(8).standard_normal((200, 8)) * 2
    found = lattice.nearest_e8(points)
    assert ((found * 2) % 1 == 0).all() and (found.sum(1) % 2 == 0).all()
    around = found[:, None, :] + lattice._NEIGHBOURS[None]
    assert (((points - found) ** 2).sum(1)[:, None] <= ((points[:, None] - around) ** 2).sum(2) + 1e-9).all()


def test_decontamination(spark, documents):
    rng = random.Random(10)
    item, short = text_of(rng, 40), text_of(rng, 3)
    items = [(1, item), (2, short), (3, ""), (4, None), (10, text_of(rng, 13)), (None, text_of(rng, 6)), (1, text_of(rng, 20))]
    words = item.split()
    rows = [
        (1, item), (2, text_of(rng, 50) + " " + " ".join(words[5:18]) + " " + text_of(rng, 30)), (3, " ".join(words[5:17])),
        (4, f"A-{short.upper()}!"), (5, None), (6, ""), (7, text_of(rng, 2000) + " " + " ".join(words[:13])),
        (8, f"{item} {item}"), (9, items[4][1] + " " + items[5][1]), (None, item), (9, text_of(rng, 30)),
        (11, " ".join(words[:20] + ["x"] + words[21:])), (12, "; ".join(words)),
    ]
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, ord string")
    found = winnow.decontaminated(documents(rows), bench).orderBy("ord").collect()

    def cut(text):
        return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]

    expected = []
    for doc_id, text in order_of(rows):
        doc, hit, ids = cut(text), set(), set()
        for item_id, item_text in items:
            parts = cut(item_text)
            n = min(13, len(parts))
            windows = {tuple(parts[a : a + n]) for a in range(len(parts) - n + 1)} if n else set()
            for a in range(len(doc) - n + 1):
                if n and tuple(doc[a : a + n]) in windows:
                    hit.update(range(a, a + n))
                    ids.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        expected.append((doc_id, len(doc), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(doc)))
    assert [tuple(r)[1:] for r in found] == expected
    assert winnow.decontaminated(documents([]), bench).isEmpty()
    assert not winnow.decontaminated(documents(rows), bench.limit(0)).where("contaminated or n_hit > 0").count()
    assert winnow.clean(documents(rows), bench).count() == sum(not e[-1] for e in expected)


def test_no_python_in_the_plan_of_decontamination(spark, documents):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = winnow.decontaminated(documents([(1, "a b c")]), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_language(spark, documents):
    rows = [(i, f"der und {t} nicht", "de") for i, t in enumerate(["haus", "baum", "weg"] * 5)]
    rows += [(50 + i, f"the and {t} not", "en") for i, t in enumerate(["house", "tree", "way"] * 5)]
    rows += [(90, "und der", None), (91, None, "en"), (92, "12 !?", "de"), (93, "你好", "en"), (94, "housetree", "en")]
    df = spark.createDataFrame([(*r, "s", "z") for r in rows], "doc_id long, text string, lang string, source string, predicted string")
    model = langid.trained(df, learn_from=F.col("doc_id") < 90)
    found = {r.doc_id: r.p for r in langid.predicted(df.drop("predicted"), model).select("doc_id", F.col("predicted").alias("p")).collect()}
    assert found[0].lang_pred == "de" and found[50].lang_pred == "en" and found[90].lang_pred == "de"
    assert found[91].lang_pred == found[92].lang_pred == "und" and found[91].score == found[92].score == 0
    assert found[93].lang_pred in ("de", "en") and found[94].lang_pred == "en"
    assert all(0 <= p.score <= 1 for p in found.values())
    kept = langid.identified(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(found) - {91, 92}
    nothing = langid.trained(df, learn_from=F.lit(False))
    assert {r.predicted.lang_pred for r in langid.predicted(df.drop("predicted"), nothing).collect()} == {"und"}
    assert langid.predicted(df.limit(0), model).isEmpty()


@pytest.mark.parametrize("doc_id", [None, 7, 13])
def test_the_sample_does_not_depend_on_ids(spark, doc_id):
    """All rows share an id: the sample is still about as large as asked for, and both languages are learnt."""
    rng = random.Random(2)
    rows = [(doc_id, f"the {text_of(rng, 6)}", "en") for _ in range(3000)] + [(doc_id, "der und nicht", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.trained(df, F.lit(True), sample_documents=300)
    assert model.languages == ["de", "en"]
    the = next(words.hashes[0] for words in letter_words(pa.array(["the"])))
    known, at = model.look_up(0, np.array([the]))
    share = np.exp(model.scores[0][at[0], 1] - np.log(1 / 7))
    assert known[0] and 0.5 < share < 2.5
    texts = spark.createDataFrame([(doc_id, "nicht der"), (doc_id, "the kalo")], "doc_id long, text string")
    assert {r.text: r.predicted.lang_pred for r in langid.predicted(texts, model).collect()} == {"nicht der": "de", "the kalo": "en"}


def plain_prediction(text, counts, times_of_lang):
    """Scores by dictionaries: words first, then the longest n-grams that are known."""
    sums = dict.fromkeys(times_of_lang, 0.0)
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        for n in range(6):
            size = 6 - n if n else 0
            padded = word if size < 2 else f" {word} "
            grams = [word] if not n else [padded[i : i + size] for i in range(len(padded) - size + 1)]
            known = [g for g in grams if any(counts[size][lang][g] for lang in sums)]
            if known:
                for lang in sums:
                    found = [(counts[size][lang][g] + langid.SMOOTHING) / times_of_lang[lang][size] for g in known]
                    sums[lang] += sum(map(np.log, found)) / len(found)
                break
    return sums


def test_language_scores_are_those_of_dictionaries(spark):
    rng = random.Random(8)
    rows = []
    for i in range(90):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, " ".join(rng.choice([f"{lang}o", "the", "Été", text_of(rng, 1)]) for _ in range(rng.randint(1, 20))), lang))
    rows += rows[:7]
    model = langid.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    counts = {n: {lang: Counter() for lang in model.languages} for n in range(6)}
    for _, text, lang in rows:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            counts[0][lang][word] += 1
            for n in range(1, 6):
                padded = word if n < 2 else f" {word} "
                counts[n][lang].update(padded[i : i + n] for i in range(len(padded) - n + 1))
    for n in counts:
        every = Counter()
        for lang in counts[n]:
            every.update(counts[n][lang])
        for lang in counts[n]:
            kept = {g: c for g, c in counts[n][lang].items() if every[g] >= langid.LEAST_TIMES or n in (1, 2)}
            counts[n][lang] = Counter(kept)
    entries = {n: len({g for lang in counts[n] for g in counts[n][lang]}) for n in counts}
    times = {
        lang: [sum(counts[n][lang].values()) + langid.SMOOTHING * entries[n] for n in range(6)] for lang in model.languages
    }
    texts = [text for _, text, _ in rows] + ["deo", "frx quo", "", "12", "zzz", None, "fro " * 500]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in langid.predicted(df, model).collect():
        sums = plain_prediction(r.text or "", counts, times)
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (r.predicted.lang_pred, r.predicted.score) == ("und", 0.0)
        else:
            best = max(sums.values())
            share = 1 / sum(np.exp(s - best) for s in sums.values())
            assert abs(r.predicted.score - share) < 1e-6
            assert sums[r.predicted.lang_pred] >= best - 1e-9


def test_small_languages_are_learnt_beside_large_ones(spark):
    rows = [(i, f"the and of to in is that {'for with'.split()[i % 2]}", "en") for i in range(2000)]
    rows += [(3000 + i, "der und nicht", "de") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.trained(df, F.lit(True), sample_documents=40)
    texts = spark.createDataFrame([(1, "und nicht der"), (2, "that is the"), (3, "你好")], "doc_id long, text string")
    found = {r.doc_id: r.predicted.lang_pred for r in langid.predicted(texts, model).collect()}
    assert found == {1: "de", 2: "en", 3: "en"}
    assert [langid._quota(*x) for x in (([5, 100, 100], 45), ([3, 4], 45), ([100] * 9, 3), ([], 5))] == [20, 42, 1, 5]


def test_texts_with_letters_stay_if_no_language_is_known(spark):
    df = spark.createDataFrame([(1, "a b", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.identified(df, langid.trained(df, F.lit(True))).collect()] == [1]


def test_toxicity(spark, documents):
    rng = random.Random(11)
    rows = [(i, text_of(rng, 40) + (" vilest words" if i % 4 == 0 else "")) for i in range(400)] + [(900, None), (901, ""), (None, "a")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(7, None), (None, 1), (5000, 1)], "doc_id long, toxic int")
    learnt = toxicity.trained(documents(rows), labels, learn_from=F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r.score for r in toxicity.scored(documents(rows), learnt).collect()}
    held = [i for i in range(0, 400, 5)]
    assert all((found[i] >= 0.5) == (i % 4 == 0) for i in held)
    assert found[900] == found[901] and 0 <= found[900] < 0.5
    nothing = toxicity.trained(documents(rows), labels.limit(0), learn_from=F.lit(True))
    assert {r.score for r in toxicity.scored(documents(rows), nothing).collect()} == {0.5}
    assert toxicity.scored(documents([]), learnt).isEmpty()


def test_pages(spark):
    marked = (
        "<html><head><title>T</title><style>p{}</style><script>var a='<p>x</p>';</script></head><body><nav><ul><li>menu"
        "</ul></nav><div class='cookie-notice'>c<div>d</div></div><article><header>h</header><h1>A &amp;  B</h1><p>one<br>two "
        "<b>three</b></p><aside>no</aside><p class=ad>no<p>four&nbsp;&#233;<ul><li>five</ul><section class='comments'><p>no"
        "</section><form>no</form><!-- no --></article><footer>&copy; f</footer></body></html>"
    )
    shared = "these eight words stand on every page here"
    open_page = "<body><p>{}</p><p>unique {} text</p><p>same</p></body>"
    rows = [
        (1, "https://a.example/1", marked), (2, "https://a.example/2", open_page.format(shared, "first")),
        (3, "https://a.example/3", open_page.format(shared + " now", "second")), (4, "https://b.example/", open_page.format(shared, "x")),
        (5, None, None), (6, "x", ""), (7, "https://c.example", "<main><p>m</p></main><p>no</p>"), (8, "https://a.example/4", marked),
        (None, "https://a.example/3", open_page.format(shared + " now", "second")), (9, "u", "<article><p>cut of &am"),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, row int")
    found = pages.main_texts(df).collect()
    texts = {r.page_id: r.text for r in found}
    article = "A & B\n\none two three\n\nfour é\n\nfive"
    assert texts[1] == texts[8] == article
    assert texts[2] == "unique first text" and texts[3] == "now\n\nunique second text" == texts[None]
    assert texts[4] == f"{shared}\n\nunique x text\n\nsame"
    assert texts[5] == texts[6] == "" and texts[7] == "m" and texts[9] == "cut of &am"
    assert all(r.n_chars == len(r.text) for r in found) and len(found) == len(rows)
    assert pages.main_texts(df.limit(0)).isEmpty()


def test_elements_of_pages_are_left_out_by_whole_names_and_up_to_their_end():
    named = (
        '<article><section id="related-work">a</section><h2 id="share-of-votes">b</h2><div class="market-share">c</div>'
        '<h2 id="ads">d</h2><p aria-hidden="false">e<p data-class="ad">f<p title="the hidden cost">g<p title=\'x class="ad"\'>h'
        '<p hidden>no<p class="x AD">no<div class=cookie-notice>no</div><div id=comments>no</div></article>'
    )
    assert pages.blocks_of(named) == (list("abcdefgh"), True)
    for unclosed in (
        '<body><div class="ad">no<article>real</article></body>', '<div><div class="ad">no<article>real</article></div>',
        "<nav><ul><li>no<article>real</article>", "<article><div><aside>no</div><p>real</article>", "<title>no<body><article>real",
        "<article><p><button>no</p></article><article>real</article>", "<article><p><span class=ad>no<p>real</article>",
        "<aside><article>no</article></aside><article>real</article><div class=related><article>no</article></div>",
    ):
        assert pages.blocks_of(unclosed) == (["real"], True), unclosed
    assert pages.blocks_of("<head><title>no</title><p>a<ul><li class=ad>no<li>b</ul><table><tr><td class=ad>no<td>c</table>") == (
        ["a", "b", "c"], False
    )


def test_pages_without_marks_lose_only_what_most_bodies_of_a_host_repeat(spark):
    rng = random.Random(21)
    menu, phrase, story = text_of(rng, 12), text_of(rng, 9), [text_of(rng, 15), text_of(rng, 25)]
    own = [text_of(rng, 60) for _ in range(10)]
    page = "<body><div>{}</div>{}<div>{}</div></body>"
    rows, expected = [], {}
    for i in range(10):  # a phrase in three articles of ten, also as a heading; the menu is everywhere
        blocks = [own[i]] if i > 2 else [phrase, f"{own[i]} {phrase} end"]
        rows.append((i, "//a.example", page.format(menu, "".join(f"<p>{b}</p>" for b in blocks), f"advert {i}")))
        expected[i] = [*blocks, f"advert {i}"]
    for i in (20, 21):  # one article with other menus and adverts, on a host of its own and among others
        for host, number in (("b", i), ("a", i + 10)):
            adverts = text_of(rng, 14), text_of(rng, 5)
            html = page.format(adverts[0], "".join(f"<p>{b}</p>" for b in story), adverts[1])
            rows.append((number, f"//{host}.example", html))
            expected[number] = [adverts[0], *story, adverts[1]]
    quoted = [f"{own[i]} {phrase} {own[i + 2]}" for i in (0, 1)]  # a quote in both articles of a host
    for i in (0, 1):
        rows.append((40 + i, "//c.example", page.format(f"c {i}", quoted[i], f"d {i}")))
        expected[40 + i] = [f"c {i}", quoted[i], f"d {i}"]
    for i, mark in enumerate(("div role=main", 'div class="social" itemprop="articleBody"')):
        rows += [(50 + 2 * i + j, "//d.example", f"<p>x</p><{mark}><div>{story[0]}</div></div><p>{j}</p>") for j in (0, 1)]
        expected |= {50 + 2 * i + j: [story[0]] for j in (0, 1)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r.page_id: r.text for r in pages.main_texts(df).collect()}
    assert found == {i: "\n\n".join(blocks) for i, blocks in expected.items()}


def naive_texts(rows):
    """Texts by a plain search for repeats over all pages of a host, (page_id, url, html)."""
    size, texts, groups = pages.SUBSTRING_TOKENS, {}, defaultdict(dict)
    for page_id, url, html in rows:
        blocks, marked = pages.blocks_of(html)
        content = tuple(blocks) if marked else html
        groups[url, marked].setdefault(content, (blocks, []))[1].append(page_id)
    for (_, marked), contents in groups.items():
        of_block, of_part, tokens = defaultdict(set), defaultdict(set), {}
        for content, (blocks, _) in contents.items():
            tokens[content] = [block.split() for block in blocks]
            for block in tokens[content]:
                if len(block) >= size:
                    of_block[tuple(block)].add(content)
        body = {}
        for content, blocks in tokens.items():
            shared = [b for b in blocks if len(of_block[tuple(b)]) > 1]
            most = 2 * sum(map(len, shared)) > sum(map(len, blocks))
            longest = max(shared, key=lambda b: (len(b), pages._digest(" ".join(b)))) if most else None
            body[content] = tuple(longest) if most else (content, "whole")

        def parts(block):
            if marked and len(block) < size:
                return []
            n = min(size, len(block))
            return [(at, tuple(block[at : at + n])) for at in range(len(block) - n + 1)]

        for content, blocks in tokens.items():
            for block in blocks:
                for _, part in parts(block):
                    of_part[part].add(body[content])
        enough = max(pages.MARKED_BODIES if marked else 2, len(set(body.values())) / 2)
        for content, (blocks, ids) in contents.items():
            kept = [
                pages._without_runs(b, [(at, at + len(p)) for at, p in parts(b) if len(of_part[p]) >= enough]) for b in tokens[content]
            ]
            if marked and 4 * len(" ".join(kept).split()) < 3 * sum(map(len, tokens[content])):
                kept = blocks
            texts |= dict.fromkeys(ids, "\n\n".join(filter(None, kept)))
    return texts


def test_pages_of_all_kinds_are_searched_for_what_their_host_repeats(spark):
    rng = random.Random(22)
    notice, menu, article = text_of(rng, 14), text_of(rng, 12), "<p>{}</p><article><h2>In short</h2><p>{}</p><p>{}</p></article>"
    own = [[text_of(rng, 60) for _ in range(2)] for _ in range(12)]
    rows = [(i, "//a.example", article.format(menu, own[i][0], f"{own[i][1]}</p><p>{notice}")) for i in range(6)]
    rows += [(i, "//a.example", article.format(f"{i}", *own[i])) for i in range(6, 10)]
    rows += [(20 + i, "//a.example", article.format(f"advert {i}", *own[6])) for i in range(12)]  # copies: one body
    edited = [own[11][0].split() for _ in range(4)]  # near copies of one article on a host
    for i, words in enumerate(edited):
        words[30 + i] = "edited"
        rows.append((40 + i, "//b.example", article.format("x", " ".join(words), own[11][1].replace(" ", f" e{i} ", 1))))
    rows += [(50 + i, "//c.example", article.format(f"{i}", own[i][0], own[9][1])) for i in range(2)]  # a quote in two of two
    for i in range(60):  # pages at random, of few parts, with and without a mark
        blocks = [rng.choice([rng.choice(own)[0], notice, menu, "In short", text_of(rng, rng.randint(1, 70))]) for _ in range(6)]
        html = "".join(f"<p>{b}</p>" for b in blocks)
        rows.append((100 + i, f"//r{i % 7}.example", f"<main>{html}</main>" if rng.random() < 0.5 else f"<body>{html}</body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r.page_id: r.text for r in pages.main_texts(df).collect()}
    assert all(found[i] == "\n\n".join(["In short", *own[i]]) for i in range(10))
    assert all(found[i] == "\n\n".join(pages.blocks_of(html)[0]) for i, _, html in rows if 20 <= i < 100)
    assert found == naive_texts(rows)


def test_no_article_of_the_given_pages_is_cut(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    expected = {r.page_id: "\n\n".join(pages.blocks_of(r.html or "")[0]) for r in given.collect()}
    assert {r.page_id: r.text for r in pages.main_texts(given).collect()} == expected


def test_archives(spark):
    big = text_of(random.Random(12), 200_000)
    rows = [(1, "u", "x"), (2, "u", "x"), (3, None, None), (4, "u", ""), (5, "u\r\nv", "é\r\n\r\n"), (None, "u", "x"), (7, "u", big)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, record_type string")
    found = {r.page_id: r for r in warc.archived(df).collect()}
    assert set(found) == {r[0] for r in rows}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        assert found[page_id].payload_bytes == len(payload)
        assert found[page_id].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert found[2].record_type == "response" and found[2].payload == b"x"
    assert found[1].refers_to == found[None].refers_to == 2 and found[1].payload is None
    assert (found[4].record_type, found[3].record_type, found[3].refers_to) == ("response", "revisit", 4)
    assert {r.record_type for r in warc.archived(df, least_bytes=2).collect()} == {"response"}
    assert warc.archived(df.limit(0)).isEmpty()


def test_a_damaged_archive_is_noticed():
    import io

    whole = warc.record("response", 1, "u", b"payload", None, warc.digest(b"payload"))
    assert [block for _, block in warc.records(io.BytesIO(whole * 3))] == [b"payload"] * 3
    for bad in (whole[:-9], warc.record("response", 1, "u", b"payload", None, warc.digest(b"other"))):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad)))


def test_token_files(spark, documents):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a"), (2, "b"), (99, None)]
    tokenizer, start, expected = Tokenizer.from_file(BYTE_TOKENIZER), 0, []
    for doc_id, text in order_of(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = token_files.token_files(documents(rows).repartition(3), BYTE_TOKENIZER)
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[1]) == expected
    assert token_files.token_files(documents([]), BYTE_TOKENIZER).isEmpty()


def test_packing(spark, documents):
    rng = random.Random(13)
    rows = [(i, text_of(rng, rng.randint(1, 60))) for i in range(80)] + [(500, text_of(rng, 900)), (501, None), (501, None), (None, "")]
    df = documents(rows)
    pieces = packing.cut_into_pieces(df, WORD_TOKENIZER, 0, 128).collect()
    for share in (10_000, 25):
        placed = packing.pack_pieces(spark.createDataFrame(pieces, packing._PIECE_DDL), 128, share).collect()
        assert sorted((tuple(r) for r in pieces), key=repr) == sorted((tuple(r)[:5] for r in placed), key=repr)
        bins = {}
        for r in placed:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for items in bins.values():
            ends = np.cumsum([length for _, length in sorted(items)])
            assert [o for o, _ in sorted(items)] == [0, *ends[:-1].tolist()] and ends[-1] <= 128
        assert len(bins) <= 1.1 * packing.least_bins(np.array([r.length for r in pieces]), 128) + 2
    assert packing.packed_sequences(documents([]), WORD_TOKENIZER).isEmpty()


def test_packing_exchanges_what_partitions_over_their_bound_leave(spark):
    rng = np.random.default_rng(15)
    lengths = rng.integers(30, 70, 2000).tolist()
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing._PIECE_DDL)
    one, parts = (packing.pack_pieces(pieces, 128, share).select("sequence_id").distinct().count() for share in (2000, 100))
    assert parts <= one + 2


def test_packing_deals_equal_pieces_apart(spark):
    rows = [(None, 0, 0, 70, 5)] * 300 + [(i, 0, 0, 70, i) for i in range(100)]
    placed = packing.pack_pieces(spark.createDataFrame(rows, packing._PIECE_DDL), 128, 25).collect()
    assert len(placed) == len({r.sequence_id for r in placed}) == 400 and {r.offset for r in placed} == {0}


def test_lower_bounds_hold():
    rng = np.random.default_rng(14)
    assert packing.least_bins(np.array([60, 60, 60]), 100) == 3
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets, free = packing.best_fit_decreasing(lengths, 100)
        assert packing.least_bins(lengths, 100) <= len(free)
        assert (np.bincount(bins, lengths) == 100 - free).all() and (offsets + lengths <= 100).all()
