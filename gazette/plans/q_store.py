"""Queries on the keyed store: fold (E4), upsert (C2, H22), new vs known (C5),
additive schema (A9). Store = kept records of the first half of N upserted
into an empty store; batch = kept records of the second half."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import store as st
from ..session import ensure_checkpoint_dir, scratch_dir
from ..operators import taxonomy as tx
from . import bindings as B
from . import sqlgen as S
from .q_keywords import TAX, categories_string
from .registry import query


def kept_records(spark, sf_dir):
    """Prepared N, kept rows only, type = provisional label."""
    p = tx.prepare(B.documents_intake(spark, sf_dir), TAX)
    return p.filter(F.col("stage") == "kept").withColumn("tender_type", F.col("pre_label"))


def store_and_batch(spark, sf_dir):
    kept = kept_records(spark, sf_dir)
    half = B.split_point(spark, sf_dir)
    store = st.upsert(st.empty_store(spark), st.fold_batch(kept.filter(F.col("ord") < half)), B.STORE_TS)
    # the store is a written snapshot in a real run: materialise it once
    ensure_checkpoint_dir(spark)
    return store.checkpoint(eager=True), kept.filter(F.col("ord") >= half)


def store_view(df):
    return df.select(
        "id", "url", "source", "external_id", "title", F.md5("description").alias("description_md5"),
        "posted_date", "deadline",
        F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"),
        F.date_format("last_checked", "yyyy-MM-dd HH:mm:ss").alias("last_checked"),
        categories_string(F.col("categories")).alias("categories"), "keyword_hits",
        "score", "ai_reason", "is_research", "tender_type")


# ---- oracle -------------------------------------------------------------------

_KEPT = f"""WITH {S.N_CTE},
{S.prepared_cte(TAX)},
k AS (SELECT *, pre_label AS ttype FROM ps WHERE stage = 'kept'),
half AS (SELECT (max(doc_id) + 1) // 2 AS h FROM documents)"""


def _fold_sql(name, cond):
    return f"""{name} AS (
  SELECT url,
         arg_min({{'source': source, 'external_id': external_id}}, ord) AS f,
         arg_max({{'title': title, 'description': description, 'posted_date': posted_date,
                   'deadline': deadline, 'categories_str': categories_str, 'hits': hits}}, ord) AS l,
         arg_max(ttype, ord) FILTER (WHERE ttype IN ('commissioned', 'subsidy')) AS confirmed_type,
         min(ord) AS first_ord, count(*) AS n_records
  FROM k WHERE {cond} GROUP BY url)"""


_STORE_SQL = _KEPT + ",\n" + _fold_sql("fs", "ord < (SELECT h FROM half)") + ",\n" + \
    _fold_sql("fb", "ord >= (SELECT h FROM half)") + """,
st AS (
  SELECT row_number() OVER (ORDER BY first_ord, url) AS id, f.source AS source, f.external_id AS external_id,
         l.title AS title, url, l.description AS description, l.posted_date AS posted_date, l.deadline AS deadline,
         TIMESTAMP '1998-05-01 00:00:00' AS first_seen, TIMESTAMP '1998-05-01 00:00:00' AS last_checked,
         l.categories_str AS categories_str,
         CASE WHEN len(l.hits) > 0 THEN CAST(to_json(l.hits) AS VARCHAR) END AS keyword_hits,
         NULL::DOUBLE AS score, NULL::VARCHAR AS ai_reason, NULL::BOOLEAN AS is_research,
         coalesce(confirmed_type, 'unknown') AS tender_type
  FROM fs)"""

_UPSERT_SQL = _STORE_SQL + """,
j AS (
  SELECT st.id AS sid, fb.url IS NOT NULL AS touched, st.url IS NOT NULL AS known, fb.first_ord,
         CASE WHEN st.url IS NOT NULL THEN st.source ELSE fb.f.source END AS source,
         CASE WHEN st.url IS NOT NULL THEN st.external_id ELSE fb.f.external_id END AS external_id,
         CASE WHEN fb.url IS NOT NULL THEN fb.l.title ELSE st.title END AS title,
         coalesce(st.url, fb.url) AS url,
         CASE WHEN fb.url IS NOT NULL THEN fb.l.description ELSE st.description END AS description,
         CASE WHEN fb.url IS NOT NULL THEN fb.l.posted_date ELSE st.posted_date END AS posted_date,
         CASE WHEN fb.url IS NOT NULL THEN fb.l.deadline ELSE st.deadline END AS deadline,
         coalesce(st.first_seen, TIMESTAMP '1998-06-01 00:00:00') AS first_seen,
         CASE WHEN fb.url IS NOT NULL THEN TIMESTAMP '1998-06-01 00:00:00' ELSE st.last_checked END AS last_checked,
         CASE WHEN fb.url IS NOT NULL THEN fb.l.categories_str ELSE st.categories_str END AS categories,
         CASE WHEN fb.url IS NOT NULL THEN (CASE WHEN len(fb.l.hits) > 0 THEN CAST(to_json(fb.l.hits) AS VARCHAR) END)
              ELSE st.keyword_hits END AS keyword_hits,
         st.score AS score, st.ai_reason AS ai_reason, st.is_research AS is_research,
         CASE WHEN fb.url IS NOT NULL THEN coalesce(fb.confirmed_type, st.tender_type, 'unknown')
              ELSE st.tender_type END AS tender_type
  FROM st FULL OUTER JOIN fb ON st.url = fb.url),
u AS (
  SELECT coalesce(sid, (SELECT max(id) FROM st) + row_number() OVER (PARTITION BY sid IS NULL ORDER BY first_ord, url)) AS id, *
  FROM j)"""

_STORE_VIEW = """SELECT id, url, source, external_id, title, md5(description) AS description_md5, posted_date, deadline,
       strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(last_checked, '%Y-%m-%d %H:%M:%S') AS last_checked,
       {cats} AS categories, keyword_hits, score, ai_reason, is_research, tender_type FROM {src}"""


@query("upsert", _UPSERT_SQL + "\n" + _STORE_VIEW.format(cats="categories", src="u"))
def upsert_query(spark, sf_dir):
    store, batch = store_and_batch(spark, sf_dir)
    return store_view(st.upsert(store, st.fold_batch(batch), B.RUN_TS))


@query("upsert_fold", _KEPT + ",\n" + _fold_sql("fb", "TRUE") + """
SELECT url, f.source AS source, f.external_id AS external_id, l.title AS title, md5(l.description) AS description_md5,
       l.posted_date AS posted_date, l.deadline AS deadline, l.categories_str AS categories,
       confirmed_type, first_ord, n_records
FROM fb""")
def upsert_fold(spark, sf_dir):
    f = st.fold_batch(kept_records(spark, sf_dir))
    return f.select("url", "source", "external_id", "title", F.md5("description").alias("description_md5"),
                    "posted_date", "deadline", categories_string(F.col("categories")).alias("categories"),
                    "confirmed_type", "first_ord", "n_records")


@query("new_vs_known", _STORE_SQL + """
SELECT CAST(count(*) AS BIGINT) AS batch_records,
       CAST(count(DISTINCT url) FILTER (WHERE url IN (SELECT url FROM st)) AS BIGINT) AS known_urls,
       CAST(count(DISTINCT url) FILTER (WHERE url NOT IN (SELECT url FROM st)) AS BIGINT) AS new_urls
FROM k WHERE ord >= (SELECT h FROM half)""")
def new_vs_known(spark, sf_dir):
    store, batch = store_and_batch(spark, sf_dir)
    return st.new_vs_known(store, batch)


_ALL_SQL = _KEPT + ",\n" + _fold_sql("fs", "TRUE") + """,
st AS (SELECT row_number() OVER (ORDER BY first_ord, url) AS id, url, confirmed_type FROM fs)"""


@query("schema_backfill", _ALL_SQL + """
SELECT id, url, 'unknown' AS tender_type, TRUE AS backfilled FROM st""")
def schema_backfill(spark, sf_dir):
    """A snapshot of all records written without the type column, read back."""
    store = st.upsert(st.empty_store(spark), st.fold_batch(kept_records(spark, sf_dir)), B.STORE_TS)
    root = scratch_dir(spark, f"old-store-{uuid.uuid4().hex}")
    st.write_store(store.drop("tender_type"), root, 0)   # as before the column existed
    once = st.read_store(spark, root)
    twice = st.backfill_columns(once)                    # idempotent
    return twice.select("id", "url", "tender_type", F.lit(True).alias("backfilled"))
