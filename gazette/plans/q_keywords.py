"""Queries over N + the test dictionary: normalisation, exclusion,
categories (both physical forms), flags, labels, hits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import norm_lower, normalize
from ..operators import taxonomy as tx
from . import bindings as B
from . import sqlgen as S
from .registry import query

TAX = B.taxonomy()
CATS = TAX.category_names


def categories_string(col):
    """'cat:sub,sub;cat:sub' — the map serialised for comparison."""
    return F.array_join(F.transform(F.map_entries(col), lambda e: F.concat(e["key"], F.lit(":"),
                                                                             F.array_join(e["value"], ","))), ";")


def _prepared(spark, sf_dir):
    return tx.prepare(B.documents_intake(spark, sf_dir), TAX)


# H1 / J2 ------------------------------------------------------------------
@query("normalise_text", f"""WITH {S.N_CTE}
SELECT ord, lower(nfc_normalize(title)) AS norm_title,
       md5(lower(nfc_normalize(description))) AS norm_description_md5,
       CAST(length(lower(nfc_normalize(description))) AS BIGINT) AS norm_description_chars
FROM n""")
def normalise_text(spark, sf_dir):
    n = B.documents_intake(spark, sf_dir)
    # every fifth text is handed over decomposed (NFD): NFC must recompose it
    desc = F.when(F.col("ord") % 5 == 0, normalize("description", "NFD")).otherwise(F.col("description"))
    norm = norm_lower(desc)
    return n.select("ord", norm_lower("title").alias("norm_title"),
                    F.md5(norm).alias("norm_description_md5"),
                    F.length(norm).cast("long").alias("norm_description_chars"))


# C1 + D1, form 1 and form 2 ---------------------------------------------------
_CAT_SQL = f"""WITH {S.N_CTE},
m AS (SELECT ord, url, lower(nfc_normalize(coalesce(title, '') || ' ' || coalesce(description, ''))) AS mt FROM n)
SELECT ord, url, {S.categories_str("mt", TAX)} AS categories,
       CAST(({" + ".join(f"CASE WHEN {S.category_hit('mt', TAX, c)} THEN 1 ELSE 0 END" for c in CATS)}) AS BIGINT) AS n_categories
FROM m"""


def _categories_query(spark, sf_dir, method):
    n = B.documents_intake(spark, sf_dir)
    c = tx.categorise(n, TAX, method=method, key="ord")
    return c.select("ord", "url", categories_string(F.col("categories")).alias("categories"),
                    F.size("categories").cast("long").alias("n_categories"))


@query("keyword_categories", _CAT_SQL)
def keyword_categories(spark, sf_dir):
    return _categories_query(spark, sf_dir, "expr")


@query("keyword_join", _CAT_SQL)
def keyword_join(spark, sf_dir):
    return _categories_query(spark, sf_dir, "join")


# D2 ------------------------------------------------------------------------
@query("category_flags", f"""WITH {S.N_CTE},
m AS (SELECT ord, lower(nfc_normalize(coalesce(title, '') || ' ' || coalesce(description, ''))) AS mt FROM n)
SELECT ord, {", ".join(f"{S.category_hit('mt', TAX, c)} AS flag_{c}" for c in CATS)} FROM m""")
def category_flags(spark, sf_dir):
    c = tx.categorise(B.documents_intake(spark, sf_dir), TAX)
    return c.select("ord", *[tx.category_flag(F.col("categories"), cat).alias(f"flag_{cat}") for cat in CATS])


# B5 ------------------------------------------------------------------------
@query("exclude_filter", f"""WITH {S.N_CTE}
SELECT ord, title FROM n
WHERE NOT (coalesce(lower(nfc_normalize(title)), '') <> ''
           AND {S.any_contains("coalesce(lower(nfc_normalize(title)), '')", TAX.exclude)})""")
def exclude_filter(spark, sf_dir):
    n = B.documents_intake(spark, sf_dir)
    return n.filter(~tx.exclude_expr(norm_lower("title"), TAX)).select("ord", "title")


# H3 ------------------------------------------------------------------------
@query("pre_label", f"""WITH {S.N_CTE},
m AS (SELECT ord, lower(nfc_normalize(coalesce(title, '') || ' ' || coalesce(description, ''))) AS mt FROM n)
SELECT ord, {S.pre_label("mt", TAX)} AS pre_label FROM m""")
def pre_label(spark, sf_dir):
    n = B.documents_intake(spark, sf_dir)
    from ..functions.text import match_text
    return n.select("ord", tx.pre_label_expr(norm_lower(match_text("title", "description")), TAX).alias("pre_label"))


# H4 / H5 -------------------------------------------------------------------
_HITS = f"""WITH {S.N_CTE},
m AS (SELECT ord, lower(nfc_normalize(coalesce(title, '') || ' ' || coalesce(description, ''))) AS mt FROM n),
h AS (SELECT ord, {S.hits_list("mt", TAX)} AS hits FROM m)"""


@query("flatten_hits", _HITS + "\nSELECT ord, array_to_string(list_sort(hits), ',') AS hits FROM h")
def flatten_hits(spark, sf_dir):
    c = tx.categorise(B.documents_intake(spark, sf_dir), TAX)
    return c.select("ord", F.array_join(tx.flatten_hits(F.col("categories")), ",").alias("hits"))


@query("hits_json", _HITS + "\nSELECT ord, CASE WHEN len(hits) > 0 THEN CAST(to_json(hits) AS VARCHAR) END AS keyword_hits FROM h")
def hits_json(spark, sf_dir):
    c = tx.categorise(B.documents_intake(spark, sf_dir), TAX)
    return c.select("ord", tx.hits_json(F.col("categories")).alias("keyword_hits"))


# H17 -----------------------------------------------------------------------
@query("category_tags", f"""WITH {S.N_CTE},
m AS (SELECT ord, lower(nfc_normalize(coalesce(title, '') || ' ' || coalesce(description, ''))) AS mt FROM n)
SELECT ord, concat_ws(' ', {", ".join(f"CASE WHEN {S.category_hit('mt', TAX, c)} THEN {S.lit(B.CATEGORY_LABELS[c])} END" for c in CATS)}) AS tags
FROM m""")
def category_tags(spark, sf_dir):
    c = tx.categorise(B.documents_intake(spark, sf_dir), TAX)
    flags = [tx.category_flag(F.col("categories"), cat) for cat in CATS]
    return c.select("ord", tx.category_tags(flags, [B.CATEGORY_LABELS[x] for x in CATS]).alias("tags"))
