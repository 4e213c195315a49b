"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, jaccard_join, langid, mixing, mtree, neardup, periodic_runs, pii, quality, resampling,
               substring_dedup, token_store, toxicity)
from .common import crc_bucket, prepare, read_table
from .oracle import ORACLE_SQL  # noqa: F401  registered beside the queries


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _held_out(buckets: int, which: int):
    """Is crc32(doc_id) modulo ``buckets`` the held-out remainder? False for a null id,
    whose row is not learned from either."""
    return F.coalesce(crc_bucket(F.col("doc_id"), buckets) == which, F.lit(False)).alias("held_out")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; learned from labels whose crc32(doc_id) mod 5 is not 0."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", _held_out(5, 0), "text")
    labels = read_table(spark, sf_dir, "labels").where(crc_bucket(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(docs, labels, toxicity.character_model(docs))
    return toxicity.score(docs, model).drop("text", "found")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from documents with crc32(doc_id) mod 3 not 1."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc_bucket(F.col("doc_id"), 3) != 1))
    return langid.predict(docs.select("doc_id", _held_out(3, 1), "text"), model).drop("text")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token ids in a binary store, read back from its files."""
    folder = token_store.fresh_folder(prepare(spark))
    token_store.write(read_table(spark, sf_dir, "documents"), folder,
                      tokenizer_file("word_bpe_49k.json"), end_id=1)
    return token_store.read(spark, folder, digest=True)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text; learned from labels whose crc32(doc_id) mod 4 is not 2."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", _held_out(4, 2), "text")
    labels = read_table(spark, sf_dir, "labels").where(crc_bucket(F.col("doc_id"), 4) != 2)
    return quality.score(docs, quality.fit(docs, labels)).drop("text")


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector."""
    return mtree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 5-word shingles and a Jaccard similarity of 0.8."""
    return jaccard_join.components_of(read_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded to BPE ids and decoded again."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents"),
                          tokenizer_file("byte_bpe_50k.json"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with equal labels at cosine 0.93."""
    return neardup.link(read_table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, inclusion probability and decision of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mixing.mix(docs).drop("text")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the words of 13-word windows that an earlier document has too."""
    return substring_dedup.digest(substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text, after the tail of about every tenth was made periodic."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", periodic_runs.repeat_tail(F.col("text"), F.col("doc_id")).alias("text"))
    return periodic_runs.digest(periodic_runs.find(docs))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw of a tenth towards ``benchmark``."""
    return resampling.resample(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_toxicity, op3_language_id, op4_token_store, op5_quality,
    op6_topk_search, op7_ngram_jaccard_join, op8_bpe, op9_embedding_near_dedup, op10_mixing,
    op11_substring_dedup, op12_periodic_runs, op13_resampling)}
