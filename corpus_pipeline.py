"""The corpus pipeline: documents to packed training sequences, a stage per operator.

Every stage takes what the one before kept. All but the last give rows of documents.
"""

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import langid, minhash, packing, repeats, winnow
from pitwall.llm.queries import WORD_TOKENIZER, language_held_out
from pitwall.llm.tables import given, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without any letter are rejected."""
    return langid.identified(docs, langid.trained(docs, learn_from=~language_held_out()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows that start earlier."""
    return repeats.rewritten(docs, k=20)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return winnow.clean(docs, given(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    return packing.packed_sequences(docs, WORD_TOKENIZER, end_id=0, capacity=2048)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: Language models and tokenizers cannot be expressed in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each writes its result for the next one to read."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
