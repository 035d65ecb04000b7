"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), ``docs`` with the columns of ``documents``, and works on all
that the stage before it kept. Every stage but the last returns these columns again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vantrail.llm import exact, jaccard, languages, mixing, packing
from vantrail.session import spool

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts whose language is less certain than this are rejected with those that have no letters.
LEAST_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; a null ``lang`` is filled with what was found."""
    docs = docs.select(*COLUMNS)
    model = languages.learn(docs.where(~languages.held_out()))
    named = languages.identify(docs, model).where((F.col("lang_pred") != languages.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return named.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact.deduplicate(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: five words a shingle, similarity of 0.8 or more."""
    return jaccard.one_of_each(docs.select(*COLUMNS), jaccard.Rule())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that every source has the same weight, in random order."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens; ``row`` tells repeated documents apart."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: SQL cannot say language identification, tokens or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the result of each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = spool(stage(spark, docs, sf_dir), name)
    return docs
