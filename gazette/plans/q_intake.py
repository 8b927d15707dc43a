"""Intake queries: validation, caps, since filter, keyword union, source
union, run counters and the uncategorised sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scoring as SC
from ..operators import stats as STT
from ..operators import store as ST
from ..operators import taxonomy as tx
from ..sources import intake as IN
from . import bindings as B
from . import sqlgen as S
from .q_feeds import feed_items, json_items
from .q_html import DETAIL_SQL, container_rows, detail_rows
from .q_keywords import TAX
from .registry import ORACLE, query

# Defects spliced into N for validation (same SQL text in both engines).
VALIDATE_SPLICE = {
    "source": "CASE WHEN ord % 10 = 9 THEN 'rss' WHEN ord % 4 = 0 THEN 'jst' WHEN ord % 4 = 1 THEN 'mext' "
              "WHEN ord % 4 = 2 THEN 'nedo' ELSE 'jgrants' END",
    "url": "CASE WHEN ord % 12 = 5 THEN 'ftp://d.example/' || CAST(ord AS STRING) ELSE url END",
    "title": f"CASE WHEN ord % 14 = 3 THEN '{chr(0x3000)} ' WHEN ord % 14 = 4 THEN '{chr(0x3000)}' || title || '{chr(0x3000)}' "
             "ELSE title END",
    "tender_type": "CASE WHEN ord % 15 = 7 THEN 'grant' WHEN ord % 15 = 8 THEN NULL ELSE tender_type END",
}


def _spliced_n(spark, sf_dir):
    n = B.documents_intake(spark, sf_dir)
    return n.select("ord", *[F.expr(VALIDATE_SPLICE[c]).alias(c) if c in VALIDATE_SPLICE else F.col(c)
                             for c in ("source", "url", "title", "tender_type")])


def _sql_splice(c):
    return VALIDATE_SPLICE[c].replace("STRING", "VARCHAR")


VALIDATE_SQL = f"""WITH {S.N_CTE},
v0 AS (SELECT ord, {_sql_splice("source")} AS source, {_sql_splice("url")} AS url,
              {S.ustrip(_sql_splice("title"))} AS title, coalesce({_sql_splice("tender_type")}, 'unknown') AS tender_type FROM n)
SELECT ord, source, url, title, tender_type,
       concat_ws(',', CASE WHEN source NOT IN ('jgrants', 'nedo', 'jst', 'mext') THEN 'source' END,
                      CASE WHEN NOT (starts_with(url, 'http://') OR starts_with(url, 'https://')) THEN 'url' END,
                      CASE WHEN length(title) = 0 THEN 'title' END,
                      CASE WHEN tender_type NOT IN ('commissioned', 'subsidy', 'unknown') THEN 'tender_type' END) AS errors,
       (source IN ('jgrants', 'nedo', 'jst', 'mext') AND (starts_with(url, 'http://') OR starts_with(url, 'https://'))
        AND length(title) > 0 AND tender_type IN ('commissioned', 'subsidy', 'unknown')) AS valid
FROM v0"""


@query("validate_records", VALIDATE_SQL)
def validate_records(spark, sf_dir):
    v = IN.validate_records(_spliced_n(spark, sf_dir))
    return v.select("ord", "source", "url", "title", "tender_type", F.array_join("errors", ",").alias("errors"), "valid")


@query("batch_cap", f"""WITH {S.N_CTE}
SELECT ord, url, title FROM n ORDER BY ord LIMIT 100""")
def batch_cap(spark, sf_dir):
    return IN.cap(B.documents_intake(spark, sf_dir), 100).select("ord", "url", "title")


_JSON_EXPECTED = ORACLE["json_items"]


@query("since_filter", f"""SELECT id, posted_date FROM ({_JSON_EXPECTED}) j
WHERE posted_date IS NULL OR posted_date >= DATE '1997-01-01'""")
def since_filter(spark, sf_dir):
    return IN.since_filter(json_items(spark, sf_dir), B.SINCE).select("id", "posted_date")


UNION_KEYWORDS = ["ev", "iter", "License", "token", "ción", "ß"]
UNION_LIMIT = 50


def _kw_sql():
    vals = ", ".join(f"({i}, {S.lit(w.lower())})" for i, w in enumerate(UNION_KEYWORDS))
    cap_n = max(10, UNION_LIMIT // len(UNION_KEYWORDS))
    return f"""WITH {S.N_CTE},
kw(i, w) AS (VALUES {vals}),
m AS (SELECT kw.i AS kw_index, n.* FROM n JOIN kw
        ON contains(lower(nfc_normalize(concat_ws(' ', n.title, n.description))), kw.w)),
r AS (SELECT *, row_number() OVER (PARTITION BY kw_index ORDER BY ord DESC) AS kw_rank FROM m),
rc AS (SELECT * FROM r WHERE kw_rank <= {cap_n}),
d AS (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY coalesce(external_id, url) ORDER BY kw_index, kw_rank) = 1)
SELECT kw_index, kw_rank, ord, external_id, url FROM d ORDER BY kw_index, kw_rank LIMIT {UNION_LIMIT}"""


@query("keyword_union", _kw_sql())
def keyword_union(spark, sf_dir):
    n = B.documents_intake(spark, sf_dir)
    u = IN.keyword_union(n, UNION_KEYWORDS, limit=UNION_LIMIT)
    return u.select(F.col("kw_index").cast("int").alias("kw_index"), F.col("kw_rank").cast("long").alias("kw_rank"),
                    "ord", "external_id", "url")


# ---- source union: jst (detail pages), mext (feed), nedo (listing), jgrants (disabled)

def _sources(spark, sf_dir):
    def jst():
        d = detail_rows(spark, sf_dir)
        return d.select(F.col("page_id").alias("src_key"), F.lit(0).cast("long").alias("pos"),
                        "source", "external_id", "title", "url", "posted_date", "deadline")

    def mext():
        f = feed_items(spark, sf_dir)
        return f.select(F.col("id").alias("src_key"), F.col("pos").cast("long").alias("pos"), "source", "external_id",
                        "title", "url", "posted_date", "deadline")

    def nedo():
        c = container_rows(spark, sf_dir)
        return c.select(F.col("page_id").alias("src_key"), "pos", F.lit("nedo").alias("source"),
                        F.lit(None).cast("string").alias("external_id"), "title", F.col("link").alias("url"),
                        "posted_date", "deadline")

    def jgrants():  # the search source is disabled: it yields no records
        return spark.createDataFrame([], "src_key long, pos long, source string, external_id string, title string, "
                                         "url string, posted_date date, deadline date")
    return [("jst", jst), ("mext", mext), ("nedo", nedo), ("jgrants", jgrants)]


def _union_sql():
    parts = [
        f"SELECT 0 AS source_rank, d.page_id AS src_key, CAST(0 AS BIGINT) AS pos, d.source, d.external_id, d.title, d.url, "
        f"d.posted_date, d.deadline FROM ({DETAIL_SQL}) d",
        f"SELECT 1, f.id, CAST(f.pos AS BIGINT), f.source, f.external_id, f.title, f.url, f.posted_date, f.deadline "
        f"FROM ({ORACLE['feed_items']}) f",
        f"SELECT 2, c.page_id, CAST(c.pos AS BIGINT), 'nedo', NULL, c.title, c.link, c.posted_date, c.deadline "
        f"FROM ({ORACLE['container_rows']}) c",
    ]
    return " UNION ALL ".join(parts)


@query("source_union", _union_sql())
def source_union(spark, sf_dir):
    u, _ = IN.union_sources(spark, _sources(spark, sf_dir))
    return u.select(F.col("source_rank").cast("int").alias("source_rank"), "src_key", "pos", "source", "external_id",
                    "title", "url", "posted_date", "deadline")


@query("source_counts", f"""SELECT source, CAST(count(*) AS BIGINT) AS n FROM ({_union_sql()}) u GROUP BY source""")
def source_counts(spark, sf_dir):
    u, _ = IN.union_sources(spark, _sources(spark, sf_dir))
    return u.groupBy("source").agg(F.count(F.lit(1)).cast("long").alias("n"))


# ---- run counters ------------------------------------------------------------------

def run_parts(spark, sf_dir):
    prepared = tx.prepare(B.documents_intake(spark, sf_dir), TAX)
    kept = prepared.filter(F.col("stage") == "kept").withColumn("tender_type", F.col("pre_label"))
    folded = ST.fold_batch(kept).withColumnRenamed("url", "id")
    answers = SC.validate_answers(SC.score_rows(folded, SC.rule_scorer_factory, key="id"))
    return prepared, answers


_RUN_SQL = f"""WITH {S.N_CTE},
{S.prepared_cte(TAX)},
k AS (SELECT * FROM ps WHERE stage = 'kept'),
fb AS (SELECT url, arg_max({{'title': title, 'description': description}}, ord) AS l FROM k GROUP BY url),
sc AS (SELECT length({S.sanitise("l.title", 300)}) AS lt, length({S.sanitise("l.description", 800)}) AS ld FROM fb),
ag AS (SELECT count(*) FILTER (WHERE NOT (lt % 13 = 0 OR ld % 17 = 0)) AS ok,
              count(*) FILTER (WHERE lt % 13 = 0 OR ld % 17 = 0) AS bad FROM sc)"""


@query("run_stats", _RUN_SQL + """
SELECT CAST(count(*) AS BIGINT) AS fetched, NULL::BIGINT AS truncated_to,
       CAST(count(*) FILTER (WHERE stage = 'excluded') AS BIGINT) AS excluded,
       CAST(count(*) FILTER (WHERE stage = 'no_category') AS BIGINT) AS no_category,
       CAST(count(*) FILTER (WHERE stage = 'kept') AS BIGINT) AS upserted,
       CAST(count(*) FILTER (WHERE stage = 'kept' AND pre_label = 'subsidy') AS BIGINT) AS subsidy_pre_labeled,
       CAST(count(*) FILTER (WHERE stage = 'kept' AND pre_label = 'commissioned') AS BIGINT) AS commissioned_pre_labeled,
       CAST(count(*) FILTER (WHERE stage = 'kept' AND pre_label = 'unknown') AS BIGINT) AS unknown_pre_labeled,
       CAST((SELECT ok FROM ag) AS BIGINT) AS ai_classified, CAST(0 AS BIGINT) AS ai_skipped,
       CAST((SELECT bad FROM ag) AS BIGINT) AS failed,
       CASE WHEN (SELECT bad FROM ag) > 0 THEN 1 ELSE 0 END AS exit_status
FROM ps""")
def run_stats(spark, sf_dir):
    prepared, answers = run_parts(spark, sf_dir)
    return STT.run_stats(prepared, answers)


@query("uncategorised_sample", f"""WITH {S.N_CTE},
{S.prepared_cte(TAX)}
SELECT ord, substring(title, 1, 80) AS sample FROM ps WHERE stage = 'no_category' ORDER BY ord LIMIT 3""")
def uncategorised_sample(spark, sf_dir):
    prepared = tx.prepare(B.documents_intake(spark, sf_dir), TAX)
    return STT.uncategorised_sample(prepared)
