"""Intake steps: record validation, union of sources, batch cap, since
filter, and the keyword-union of a search source."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import constants as K
from ..functions.text import norm_lower, py_norm_lower, unicode_strip
from ..operators.ordering import keep_first


def validate_records(df: DataFrame, sources=K.SOURCES, types=K.TENDER_TYPES) -> DataFrame:
    """Record validation (B1, H20): title Unicode-stripped; ``errors`` lists
    the failed rules (source, url, title, tender_type); ``valid`` is true
    when there is none. A missing type defaults to 'unknown'. ``sources`` is
    a collection of names or a regular expression (str) names must match."""
    title = unicode_strip(F.col("title"))
    ttype = F.coalesce(F.col("tender_type"), F.lit(K.UNKNOWN))
    url_ok = F.coalesce(F.col("url").startswith(K.URL_PREFIXES[0]) | F.col("url").startswith(K.URL_PREFIXES[1]),
                        F.lit(False))
    errors = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("source").rlike(sources) if isinstance(sources, str)
                           else F.col("source").isin(list(sources)), F.lit(False)), F.lit("source")),
        F.when(~url_ok, F.lit("url")),
        F.when(F.coalesce(F.length(title), F.lit(0)) == 0, F.lit("title")),
        F.when(~ttype.isin(list(types)), F.lit("tender_type")),
    ))
    return (df.withColumn("title", title).withColumn("tender_type", ttype)
              .withColumn("errors", errors).withColumn("valid", F.size("errors") == 0))


def split_valid(df: DataFrame, sources=K.SOURCES) -> tuple:
    v = validate_records(df, sources)
    return v.filter("valid").drop("errors", "valid"), v.filter(~F.col("valid"))


def union_sources(spark: SparkSession, loaders: list) -> tuple:
    """Union of named sources in the given order.

    ``loaders`` is a list of ``(name, fn)``; ``fn()`` returns the source's
    DataFrame. A source that fails to load is counted and skipped, the others
    go on. Returns ``(union, failures)`` with ``source_rank`` added."""
    frames, failures = [], []
    for rank, (name, fn) in enumerate(loaders):
        try:
            df = fn()
            df.schema  # resolve now: a missing path or bad schema fails here
            frames.append(df.withColumn("source_rank", F.lit(rank)))
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            failures.append((name, type(exc).__name__))
    if not frames:
        raise ValueError("no source could be loaded")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    fails = spark.createDataFrame(failures or [], "source string, error string")
    return union, fails


def cap(df: DataFrame, n: int | None, order="ord") -> DataFrame:
    """First ``n`` records in input order (F3); None keeps all."""
    if n is None:
        return df
    return df.orderBy(order).limit(n)


def since_filter(df: DataFrame, since: _dt.date | None) -> DataFrame:
    """Keep records posted on/after ``since`` or without a posted date."""
    if since is None:
        return df
    return df.filter(F.col("posted_date").isNull() | (F.col("posted_date") >= F.lit(since)))


def keyword_union(df: DataFrame, keywords: list, text: Callable | None = None, newest: str = "ord",
                  key=None, limit: int = K.DEFAULT_UNION_LIMIT, since: _dt.date | None = None) -> DataFrame:
    """Union of per-keyword result sets.

    Per keyword: matching rows, newest first, at most
    ``max(10, limit // n_keywords)``; concatenated in keyword order; repeated
    keys (``coalesce(external_id, url)``) kept once, first occurrence wins;
    at most ``limit`` rows overall. One scan tags each row with the indices of
    the keywords it matches (no join); the per-keyword cut is a
    ``row_number() <= cap`` filter that Spark evaluates partially before the
    shuffle (WindowGroupLimit), so a keyword matching a third of the table
    sends only ``cap`` rows per map task."""
    if limit <= 0:
        raise ValueError(f"a keyword union needs room for some rows, not {limit}")
    if not keywords:
        return df.limit(0)
    if since is not None:                       # the search's start-date parameter
        df = df.filter(F.col("posted_date") >= F.lit(since))
    per_kw = max(K.MIN_PER_KEYWORD, limit // max(1, len(keywords)))
    t = text(df) if text is not None else norm_lower(F.concat_ws(" ", F.col("title"), F.col("description")))
    hits = F.filter(F.array(*[F.when(t.contains(py_norm_lower(w)), F.lit(i)) for i, w in enumerate(keywords)]),
                    lambda x: x.isNotNull())
    tagged = df.select("*", F.explode(hits).alias("kw_index"))
    w = Window.partitionBy("kw_index").orderBy(F.col(newest).desc())
    ranked = tagged.withColumn("kw_rank", F.row_number().over(w)).filter(F.col("kw_rank") <= per_kw)
    k = key if key is not None else F.coalesce(F.col("external_id"), F.col("url"))
    ranked = ranked.withColumn("_key", k).withColumn("_ord", F.struct("kw_index", "kw_rank"))
    first = keep_first(ranked, "_key", "_ord")
    return first.orderBy("kw_index", "kw_rank").limit(limit).drop("_key", "_ord")
