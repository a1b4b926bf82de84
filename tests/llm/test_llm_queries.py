"""The registered queries: against SQL, against plain versions over the given tables, and on their schemas."""

import os
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pitwall.llm import packing
from pitwall.llm.oracle import ORACLE_SQL
from pitwall.llm.queries import BYTE_TOKENIZER, QUERIES, WORD_TOKENIZER

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def given(sf_dir, table, *columns):
    return pq.read_table(f"{sf_dir}/{table}.parquet", columns=list(columns)).to_pylist()


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE_SQL[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    names = sorted(types)
    places = [list(types).index(n) for n in names]
    expected = sorted((tuple(row[i] for i in places) for row in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == expected
    assert expected


def test_there_are_thirteen_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_token_files_equal_the_library(spark, sf_dir):
    tokenizer = Tokenizer.from_file(BYTE_TOKENIZER)
    start, expected = 0, []
    for row in sorted(given(sf_dir, "documents", "doc_id", "text"), key=lambda r: r["doc_id"]):
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 2]
        expected.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = QUERIES["op9_token_files"](spark, sf_dir)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in found.collect()) == expected


def pieces_by_hand(docs):
    tokenizer, expected = Tokenizer.from_file(WORD_TOKENIZER), {}
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected[doc_id, piece] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return expected


def check_packing(rows, expected):
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences)


def test_packing_is_valid_and_close_to_its_bound(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in given(sf_dir, "documents", "doc_id", "text")]
    expected = pieces_by_hand(docs)
    used = check_packing(QUERIES["op10_packing"](spark, sf_dir).collect(), expected)
    bound = packing.least_bins(np.array([length for _, length, _ in expected.values()]), 2048)
    assert bound <= used <= bound + 1


def test_pipeline_stages(spark, sf_dir):
    """Every stage on its own input, against plain versions; then the whole run."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "substring_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language":
            assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "near_dedup":
            ids = set(before)
            found = {r.doc_id: r for r in near(spark, before).collect()}
            assert set(after) == {i for i in ids if found[i].kept}
        elif name == "substring_dedup":
            assert set(after) == set(before)
            expected = without_repeats({i: r.text for i, r in before.items()})
            assert {i: r.text.split() for i, r in after.items()} == expected
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            gone = set(before) - set(after)
            assert gone == contaminated(before, given(sf_dir, "benchmark", "text"))
        kept = after
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(rows, pieces_by_hand([(i, r.text) for i, r in kept.items()]))


def near(spark, rows):
    from pitwall.llm import minhash

    return minhash.near_duplicates(spark.createDataFrame([(i, r.text) for i, r in rows.items()], "doc_id long, text string"))


def without_repeats(texts, k=20):
    seen, kept = {}, {}
    for i in sorted(texts):
        words, gone = texts[i].split(), set()
        for at in range(len(words) - k + 1):
            if seen.setdefault(tuple(words[at : at + k]), (i, at)) != (i, at):
                gone.update(range(at, at + k))
        kept[i] = [w for p, w in enumerate(words) if p not in gone]
    return kept


def contaminated(rows, items):
    import re

    def words_of(text):
        table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(table)) if w]

    windows = set()
    for item in items:
        words = words_of(item["text"])
        n = min(13, len(words))
        windows.update(tuple(words[a : a + n]) for a in range(len(words) - n + 1) if n)
    gone = set()
    for i, row in rows.items():
        words, hit = words_of(row.text), set()
        for n in {len(w) for w in windows}:
            for a in range(len(words) - n + 1):
                if tuple(words[a : a + n]) in windows:
                    hit.update(range(a, a + n))
        if hit and 20 * len(hit) >= len(words):
            gone.add(i)
    return gone


def test_language_and_toxicity_on_held_out_rows(spark, sf_dir):
    docs = {r["doc_id"]: r for r in given(sf_dir, "documents", "doc_id", "lang", "text")}
    found = QUERIES["op1_language"](spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(docs)
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert np.mean([r.lang_pred == docs[r.doc_id]["lang"] for r in held]) > 0.95
    scores = QUERIES["op3_toxicity"](spark, sf_dir).collect()
    assert {r.doc_id for r in scores} == set(docs) and all(0 <= r.score <= 1 for r in scores)
    assert all(r.predicted == (r.score >= 0.5) for r in scores)
