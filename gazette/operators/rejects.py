"""Rows that a run could not use, as one output: (source, key, stage, error).

Every stage that leaves something out adds its rows here, so that what was
fetched is always the sum of what was used and what was rejected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

COLUMNS = ("source", "key", "stage", "error")


def _rows(df: DataFrame, source, key, stage: str, error) -> DataFrame:
    text = lambda c: c if isinstance(c, Column) else F.lit(c)
    return df.select(text(source).cast("string").alias("source"), text(key).cast("string").alias("key"),
                     F.lit(stage).alias("stage"), text(error).cast("string").alias("error"))


def of_validation(rejected: DataFrame) -> DataFrame:
    """Records that fail validation, with the failed rules."""
    return _rows(rejected, F.col("source"), F.coalesce("external_id", "url", "title"), "validation", F.array_join("errors", ","))


def of_answers(answers: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose score is missing or not valid; a scorer's exception is named."""
    said = F.when(F.col("scorer_error").isNotNull(), F.concat_ws(": ", "error", "scorer_error")).otherwise(F.col("error"))
    return _rows(answers.where(~F.col("ok")), None, F.col(key), "scorer", said)


def of_documents(status: DataFrame, source: str, key: str) -> DataFrame:
    """Documents of a source that could not be read, from a status table
    (key, ..., error)."""
    return _rows(status.where(F.col("error").isNotNull()), source, F.col(key), "document", F.col("error"))


def of_items(errors: DataFrame, source: str, key: str) -> DataFrame:
    """Items of a document that are left out, from (key, pos, error)."""
    return _rows(errors, source, F.concat_ws("#", F.col(key).cast("string"), F.col("pos").cast("string")), "item", F.col("error"))


def of_details(listing: DataFrame, good: DataFrame, bad: DataFrame, source: str, url: str = "url") -> DataFrame:
    """Listed rows without a good detail page: those of ``bad`` (url, error)
    have an unusable one, the others none."""
    lost = listing.join(good.select(url).distinct(), url, "left_anti")
    said = bad.groupBy(url).agg(F.min("error").alias("error"))
    lost = lost.select(url).join(said, url, "left")
    return _rows(lost, source, F.col(url), "detail", F.coalesce("error", F.lit("detail page missing")))


def of_failures(failures: DataFrame) -> DataFrame:
    """Sources that could not be loaded at all."""
    return _rows(failures, F.col("source"), None, "source", F.col("error"))


def union(parts: list) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
