"""A pretraining corpus from ``documents`` in five stages, each of them one of
the corpus operators. A stage's result is written before the next one reads it.

Every stage but the last returns the columns of ``documents``. Texts that the
second stage shortens get a new ``n_chars``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.llm import jaccard, langid, linededup, mix, packing
from gazette.llm.common import BLANKS, prepare, read_table, staged

TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: those that are empty, have no letter or
    are ambiguous go. Learns from the labelled ones among them."""
    prepare(spark)
    model = langid.fit(docs)
    known = langid.identify(docs, model).where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous"))
    return known.select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that others share; those left blank go."""
    prepare(spark)
    out = linededup.line_dedup(docs)
    out = out.where(F.btrim("text", F.lit(BLANKS)) != "")
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    prepare(spark)
    return jaccard.distinct_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, some twice, some not at all."""
    prepare(spark)
    taken = mix.mix(docs).where(F.col("copies") > 0)
    return taken.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    prepare(spark)
    return packing.best_fit_pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packed", packed),
]

# Neither n-gram classifiers nor a tokenizer can be said in SQL; the tests hold
# the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
