"""The queries of the corpus operators: each applies one operator to its whole table with production
parameters.  Signature ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, divergence, fingerprint, interactions, language, lines, minhash, neighbours, packing, quality_vote, secret_scan, sharding, urlfilter
from daybook.llm.common import table

PACK_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# The rules of the contract.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), PACK_TOKENIZER)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classify(table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.classify(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", sharding.shard_names(sharding.SHARDS)).select("doc_id", "slot", "shard")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_quality_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality_vote.classify(table(spark, sf_dir, "documents"), labels)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_fingerprints": op2_fingerprints,
    "op3_minhash": op3_minhash,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_language_id": op5_language_id,
    "op6_neighbours": op6_neighbours,
    "op7_secrets": op7_secrets,
    "op8_bpe": op8_bpe,
    "op9_url_filter": op9_url_filter,
    "op10_sharding": op10_sharding,
    "op11_source_divergence": op11_source_divergence,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_quality_vote": op13_quality_vote,
}
