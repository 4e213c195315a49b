"""A training corpus from ``documents``: identify, deduplicate, redact, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankbeam.llm import bpe, jaccard_join, langid, mixing, pii
from rankbeam.llm.common import crc_bucket, prepare, read_table, written
from rankbeam.llm.queries import tokenizer_file


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified from the text alone; the model learns
    from the documents whose crc32(doc_id) mod 3 is not 1."""
    prepare(spark)
    model = langid.fit(docs.where(crc_bucket(F.col("doc_id"), 3) != 1))
    return langid.drop_unidentified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at a similarity of 0.8."""
    return jaccard_join.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; all documents stay."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards flatter source, language and topic shares."""
    return mixing.keep_mixed(docs, budget=0.5)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the BPE ids of every document."""
    done = bpe.encode(docs, tokenizer_file("byte_bpe_50k.json"))
    return done.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: SQL cannot express the learned and the exact-similarity stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each one's result written and read again."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
