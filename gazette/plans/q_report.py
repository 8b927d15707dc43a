"""Report queries over T (stored rows from orders)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dates as D
from ..operators import report as R
from . import bindings as B
from . import sqlgen as S
from .registry import query

CATS = list(B.CATEGORY_LABELS)
LABELS = B.CATEGORY_LABELS

T_CTE = """t AS (
  SELECT o_orderkey AS id, 'mext' AS source, CAST(o_orderkey AS VARCHAR) AS external_id,
         o_orderpriority || ' order ' || CAST(o_orderkey AS VARCHAR) AS title,
         'https://n.example/' || CAST(o_orderkey AS VARCHAR) AS url,
         'customer ' || CAST(o_custkey AS VARCHAR) || ' status ' || o_orderstatus AS description,
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderdate AS DATE) END AS posted_date,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS deadline,
         o_orderkey % 2 = 0 AS flag_grid, o_orderkey % 3 = 0 AS flag_reactor, o_orderkey % 5 = 0 AS flag_radiation,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 11 AS DOUBLE) END AS score,
         CASE WHEN o_orderkey % 7 <> 0 THEN 'reason ' || CAST(o_orderkey % 11 AS VARCHAR) END AS ai_reason,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 4 = 0 END AS is_research,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'subsidy'
              WHEN o_orderstatus = 'O' THEN 'commissioned' ELSE 'unknown' END AS tender_type
  FROM orders)"""

AS_OF_SQL = "DATE '1998-06-01'"
TAGS_SQL = "concat_ws(' ', " + ", ".join(f"CASE WHEN flag_{c} THEN {S.lit(LABELS[c])} END" for c in CATS) + ")"
BADGE_SQL = f"""CASE WHEN deadline IS NULL THEN NULL
     WHEN date_diff('day', {AS_OF_SQL}, deadline) < 0 THEN {S.lit(K.BADGE_EXPIRED)}
     WHEN date_diff('day', {AS_OF_SQL}, deadline) = 0 THEN {S.lit(K.BADGE_TODAY)}
     WHEN date_diff('day', {AS_OF_SQL}, deadline) <= {K.BADGE_SOON_DAYS}
          THEN {S.lit(K.BADGE_DAYS_PREFIX)} || CAST(date_diff('day', {AS_OF_SQL}, deadline) AS VARCHAR) || {S.lit(K.BADGE_DAYS_SUFFIX)}
     ELSE strftime(deadline, '%m/%d') || {S.lit(K.BADGE_DATE_SUFFIX)} END"""
BAND_SQL = """CASE WHEN score IS NULL THEN 'none' WHEN score >= 8 THEN 'high' WHEN score >= 5 THEN 'mid' ELSE 'low' END"""
ACTIVE_SQL = f"""a AS (
  SELECT *, row_number() OVER (ORDER BY deadline ASC NULLS LAST, score DESC NULLS LAST, id DESC) AS board_rank
  FROM t
  WHERE (deadline IS NULL OR deadline >= {AS_OF_SQL}) AND score IS NOT NULL AND score >= 5
    AND tender_type IS DISTINCT FROM 'subsidy')"""


def board(spark, sf_dir):
    return R.active_board(B.orders_store(spark, sf_dir), B.AS_OF, CATS, LABELS)


@query("active_board", f"""WITH {T_CTE}, {ACTIVE_SQL}
SELECT board_rank, id, url, title, deadline, score, tender_type, {BADGE_SQL} AS badge, {BAND_SQL} AS band,
       {TAGS_SQL} AS tags FROM a""")
def active_board(spark, sf_dir):
    return board(spark, sf_dir).select("board_rank", "id", "url", "title", "deadline", "score", "tender_type",
                                       "badge", "band", "tags")


@query("tab_subset", f"""WITH {T_CTE}, {ACTIVE_SQL}
{" UNION ALL ".join(f"SELECT {S.lit(c)} AS tab, board_rank, id FROM a WHERE flag_{c}" for c in CATS)}""")
def tab_subset(spark, sf_dir):
    return R.tab_rows(board(spark, sf_dir), CATS)


@query("tab_counts", f"""WITH {T_CTE}, {ACTIVE_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_all, {", ".join(f"CAST(count(*) FILTER (WHERE flag_{c}) AS BIGINT) AS n_{c}" for c in CATS)}
FROM a""")
def tab_counts(spark, sf_dir):
    act = R.with_flags(B.orders_store(spark, sf_dir).filter(R.active_filter(B.AS_OF)), CATS)
    return R.tab_counts(act, CATS)


@query("deadline_badge", f"""WITH {T_CTE}
SELECT id, deadline, {BADGE_SQL} AS badge FROM t""")
def deadline_badge(spark, sf_dir):
    t = B.orders_store(spark, sf_dir)
    return t.select("id", "deadline", D.deadline_badge("deadline", B.AS_OF).alias("badge"))


@query("score_band", f"""WITH {T_CTE}
SELECT id, score, {BAND_SQL} AS band FROM t""")
def score_band(spark, sf_dir):
    t = B.orders_store(spark, sf_dir)
    return t.select("id", "score", D.score_band("score").alias("band"))


MONTHS_SQL = """m AS (
  SELECT date_trunc('month', posted_date) AS month, count(*) AS month_count FROM t GROUP BY 1),
mg AS (
  SELECT month, coalesce(strftime(month, '%Y年%m月'), '不明') AS month_label,
         dense_rank() OVER (ORDER BY month DESC NULLS LAST) AS month_rank, month_count FROM m)"""


@query("archive_rows", f"""WITH {T_CTE}, {MONTHS_SQL}
SELECT row_number() OVER (ORDER BY posted_date DESC NULLS LAST, id DESC) AS archive_rank, t.id, t.posted_date,
       mg.month_label, mg.month_rank, CAST(mg.month_count AS BIGINT) AS month_count,
       coalesce(strftime(t.deadline, '%Y-%m-%d'), '—') AS deadline_text, {BAND_SQL} AS band,
       replace(replace(replace(replace(replace(t.title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&#34;'), '''', '&#39;') AS title_html,
       '1998-06-01 00:00 UTC' AS generated_at
FROM t JOIN mg ON date_trunc('month', t.posted_date) IS NOT DISTINCT FROM mg.month""")
def archive_rows(spark, sf_dir):
    a = R.archive(B.orders_store(spark, sf_dir), B.RUN_TS)
    return a.select("archive_rank", "id", "posted_date", "month_label", "month_rank",
                    F.col("month_count").cast("long").alias("month_count"), "deadline_text", "band",
                    "title_html", "generated_at")


@query("month_counts", f"""WITH {T_CTE}, {MONTHS_SQL}
SELECT month_label, month_rank, CAST(month_count AS BIGINT) AS month_count,
       (SELECT CAST(count(*) AS BIGINT) FROM t) AS total_count FROM mg""")
def month_counts(spark, sf_dir):
    return R.month_counts(B.orders_store(spark, sf_dir))
