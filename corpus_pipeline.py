"""Corpus preparation pipeline: language, lines, near duplicates, secrets, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and
reread as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import language, lines, minhash, packing, registered, secret_scan
from daybook.llm.common import DOC_COLUMNS, prepare, table, written

#: A text is kept if it is this sure of its language.
LEAST_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language cannot be told (none, no letter, or an undecided score) go."""
    prepare(spark)
    docs = docs.select(*DOC_COLUMNS)
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.predict(docs, model).filter(
        (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)).select(*DOC_COLUMNS)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of equal or similar lines one line stays; documents that are left without
    any line go."""
    prepare(spark)
    kept = lines.drop_repeated_lines(docs.select(*DOC_COLUMNS))
    return (kept.withColumn("n_chars", F.length("text").cast("long"))
            .filter(F.col("text").rlike(r"\S")).select(*DOC_COLUMNS))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    prepare(spark)
    return minhash.drop_near_duplicates(docs.select(*DOC_COLUMNS), words=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    prepare(spark)
    return secret_scan.redact(docs.select(*DOC_COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*DOC_COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row per piece of a document."""
    prepare(spark)
    return packing.pack(docs, registered.PACK_TOKENIZER)


STAGES = [
    ("language", language_stage),
    ("lines", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Language scores, similarity confirmation and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
