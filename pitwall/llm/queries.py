"""The operators over the given tables, with production parameters: one query each."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import (
    collocation, compression, langid, lattice, minhash, packing, pages, repeats, token_files, toxicity, trie, warc, winnow,
)
from pitwall.llm.tables import checksum32, given

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_held_out() -> Column:
    return F.coalesce(checksum32("doc_id") % 4 == 2, F.lit(False))


def label_held_out() -> Column:
    return F.coalesce(checksum32("doc_id") % 5 == 0, F.lit(False))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents")
    model = langid.trained(documents, learn_from=~language_held_out())
    found = langid.predicted(documents.select("doc_id", language_held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "predicted.lang_pred", "predicted.score")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(given(spark, sf_dir, "documents"), k=20)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents")
    learnt = toxicity.trained(documents, given(spark, sf_dir, "labels"), learn_from=~label_held_out())
    found = toxicity.scored(documents.select("doc_id", label_held_out().alias("held_out"), "text"), learnt)
    return found.select("doc_id", "held_out", "score", "predicted")


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(given(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(given(spark, sf_dir, "pages"), least_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(given(spark, sf_dir, "embeddings"), threshold=0.93).drop("ord")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(given(spark, sf_dir, "documents"), k=5, percent=75)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminated(
        given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"), window=13, k=5
    )
    return found.drop("ord")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(given(spark, sf_dir, "documents"), BYTE_TOKENIZER, end_id=2)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(given(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=0, capacity=2048)


def op11_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(given(spark, sf_dir, "documents"), least=100, most=2_000)


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(given(spark, sf_dir, "conversations"), head_turns=checksum32("conv_id") % 9)


def op13_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents")
    model = compression.trained(documents, given(spark, sf_dir, "labels"), learn_from=~label_held_out())
    found = compression.scored(documents.select("doc_id", label_held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language, op2_repeats, op3_toxicity, op4_pages, op5_warc, op6_lattice, op7_minhash, op8_winnow, op9_token_files, op10_packing,
        op11_collocation, op12_trie, op13_compression,
    )
}
