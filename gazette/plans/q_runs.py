"""Runs over a written store (backlog, relabel, publish) and the rejected rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import rejects as RJ
from ..operators import scoring as SC
from ..operators import store as ST
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sources import feeds as FD
from ..sources import html as H
from ..sources import intake as IN
from . import bindings as B
from . import daily
from . import sqlgen as S
from .q_feeds import FEED_HOSTS, GRANT_HOSTS, GRANT_PREFIX, feed_xml_sql, json_body_sql
from .q_intake import VALIDATE_SPLICE, VALIDATE_SQL
from .q_report import MONTHS_SQL, T_CTE
from .q_scoring import CAND_SQL, VALIDATE_SQL as ANSWERS_SQL, validated
from .registry import query

CATS = list(B.CATEGORY_LABELS)


@query("reject_rows", f"""WITH {T_CTE}, {ANSWERS_SQL}
SELECT source, CAST(ord AS VARCHAR) AS key, 'validation' AS stage, errors AS error FROM ({VALIDATE_SQL}) v WHERE NOT valid
UNION ALL SELECT NULL, CAST(id AS VARCHAR), 'scorer', error FROM ans WHERE NOT ok""")
def reject_rows(spark, sf_dir):
    """Records of N that fail validation, and answers that are not valid."""
    n = B.documents_intake(spark, sf_dir)
    n = n.withColumns({c: F.expr(e) for c, e in VALIDATE_SPLICE.items()})
    _, rejected = IN.split_valid(n)
    return RJ.union([RJ.of_validation(rejected), RJ.of_answers(validated(spark, sf_dir))])


_FEED_LOST = "CASE WHEN o_orderkey % 37 = 0 THEN ' ' WHEN o_orderkey % 41 = 0 THEN 'no feed' ELSE {} END"
_BODY_LOST = "CASE WHEN o_orderkey % 43 = 0 THEN '{{\"result\": [' WHEN o_orderkey % 47 = 0 THEN '{{\"result\": {{\"id\": 1}}}}' ELSE {} END"


@query("source_reject_rows", """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS s FROM orders)
SELECT 'mext' AS source, s AS key, 'document' AS stage, CASE WHEN k % 37 = 0 THEN 'empty document' ELSE 'not a feed' END AS error
FROM o WHERE k % 37 = 0 OR k % 41 = 0
UNION ALL SELECT 'mext', s || '#0', 'item', CASE WHEN k % 23 = 0 THEN 'title' WHEN k % 29 = 0 THEN 'url' ELSE 'url not allowed' END
FROM o WHERE k % 37 <> 0 AND k % 41 <> 0 AND (k % 23 = 0 OR k % 29 = 0 OR k % 9 IN (0, 3, 6))
UNION ALL SELECT 'mext', s || '#1', 'item', 'malformed item' FROM o WHERE k % 37 <> 0 AND k % 41 <> 0 AND k % 10 = 4
UNION ALL SELECT 'jgrants', s, 'document', CASE WHEN k % 43 = 0 THEN 'not JSON' ELSE 'no list of items' END
FROM o WHERE k % 43 = 0 OR k % 47 = 0
UNION ALL SELECT 'jgrants', s || '#0', 'item', 'title' FROM o WHERE k % 43 <> 0 AND k % 47 <> 0 AND k % 23 = 0
UNION ALL SELECT 'jst', url, 'detail', 'detail page missing' FROM pages l
WHERE NOT EXISTS (SELECT 1 FROM pages d WHERE d.url = l.url AND d.page_id % 4 <> 0)""")
def source_reject_rows(spark, sf_dir):
    """Feeds, API bodies and detail pages that a run could not use, and the
    items and listing rows that it left out."""
    o = B.spread(B.table(spark, sf_dir, "orders"))
    docs = o.select(F.col("o_orderkey").alias("id"), F.expr(_FEED_LOST.format(feed_xml_sql("spark"))).alias("xml"),
                    F.expr(_BODY_LOST.format(json_body_sql())).alias("body"))
    pages = B.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    # each source is parsed once; kept is what tells the rejects
    ensure_checkpoint_dir(spark)
    fields = H.definition_fields(H.definition_pairs(pages.filter("page_id % 4 <> 0"), keep=("url", "page_id")), ["url", "page_id"]).checkpoint(eager=True)
    feeds, bodies = FD.feed_parse(docs).select("id", "n_items", "error", "pos", "read", "title", "link").checkpoint(eager=True), FD.json_parse(docs).checkpoint(eager=True)
    return RJ.union([
        RJ.of_documents(FD.status_of(feeds), "mext", "id"),
        RJ.of_items(FD.feed_item_errors(FD.entries_of(feeds), FEED_HOSTS), "mext", "id"),
        RJ.of_documents(FD.status_of(bodies), "jgrants", "id"),
        RJ.of_items(FD.json_item_errors(FD.entries_of(bodies), GRANT_PREFIX, GRANT_HOSTS), "jgrants", "id"),
        RJ.of_details(pages.select("url"), H.first_good_page(fields), H.bad_pages(fields), "jst")])


def written_store(spark, sf_dir) -> str:
    """T as the first snapshot of a new store."""
    root = scratch_dir(spark, f"run-{uuid.uuid4().hex}")
    new = ST.latest(spark, f"{root}/store")
    new.publish(B.orders_store(spark, sf_dir), list(range(new.buckets)))
    return root


def _answered(rows: str) -> str:
    """What the rule scorer answers to some rows of T."""
    return f"""s AS (SELECT id, length({S.sanitise("title", K.SCORER_TITLE_CHARS)}) AS lt,
             length({S.sanitise("description", K.SCORER_DESCRIPTION_CHARS)}) AS ld FROM {rows}),
g AS (SELECT id, CAST((lt + ld) % 11 AS DOUBLE) AS score, CAST(lt AS VARCHAR) || '/' || CAST(ld AS VARCHAR) AS reason, ld % 2 = 0 AS research,
             CASE (lt + 2 * ld) % 3 WHEN 0 THEN 'commissioned' WHEN 1 THEN 'subsidy' ELSE 'unknown' END AS ttype
      FROM s WHERE lt % 13 <> 0 AND ld % 17 <> 0)"""


@query("backlog_run", f"""WITH {T_CTE},
p AS (SELECT * FROM t WHERE score IS NULL ORDER BY id LIMIT {K.DEFAULT_MAX_RECORDS}), {_answered("p")}
SELECT t.id, CASE WHEN g.id IS NOT NULL THEN g.score ELSE t.score END AS score,
       CASE WHEN g.id IS NOT NULL THEN g.reason ELSE t.ai_reason END AS ai_reason,
       CASE WHEN g.id IS NOT NULL THEN g.research ELSE t.is_research END AS is_research,
       CASE WHEN g.id IS NOT NULL AND g.ttype <> 'unknown' THEN g.ttype ELSE t.tender_type END AS tender_type
FROM t LEFT JOIN g ON t.id = g.id""")
def backlog_run(spark, sf_dir):
    root = written_store(spark, sf_dir)
    daily.backlog_run(spark, f"{root}/store", f"{root}/site", B.RUN_TS, B.AS_OF, CATS, B.CATEGORY_LABELS,
                      SC.rule_scorer_factory, K.DEFAULT_MAX_RECORDS)
    return ST.read_store(spark, f"{root}/store").select("id", "score", "ai_reason", "is_research", "tender_type")


@query("relabel_run", f"""WITH {T_CTE}, {CAND_SQL}, {_answered("c")}
SELECT t.id, t.score, CASE WHEN g.id IS NOT NULL AND g.ttype <> 'unknown' THEN g.ttype ELSE t.tender_type END AS tender_type
FROM t LEFT JOIN g ON t.id = g.id""")
def relabel_run(spark, sf_dir):
    root = written_store(spark, sf_dir)
    daily.relabel_run(spark, f"{root}/store", f"{root}/site", B.RUN_TS, B.AS_OF, CATS, B.CATEGORY_LABELS, SC.rule_scorer_factory)
    return ST.read_store(spark, f"{root}/store").select("id", "score", "tender_type")


@query("publish_readback", f"""WITH {T_CTE}, {MONTHS_SQL}
SELECT row_number() OVER (ORDER BY posted_date DESC NULLS LAST, id DESC) AS archive_rank, t.id, t.title, mg.month_label
FROM t JOIN mg ON date_trunc('month', t.posted_date) IS NOT DISTINCT FROM mg.month""")
def publish_readback(spark, sf_dir):
    """The archive as it was published, read from the sink."""
    root = written_store(spark, sf_dir)
    paths = daily.publish_only(spark, f"{root}/store", f"{root}/site", B.RUN_TS, B.AS_OF, CATS, B.CATEGORY_LABELS)
    return spark.read.parquet(paths["archive"]).select("archive_rank", "id", "title", "month_label")
