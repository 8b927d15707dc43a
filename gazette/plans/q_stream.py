"""The streaming intake as a query: N's two halves arrive as two drops of
files, are applied as two micro-batches by Structured Streaming (foreachBatch upsert into
snapshot versions), and the final snapshot is returned. Its oracle is the
batch upsert of all kept records at once — the stream must equal it."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import store as ST
from ..schema import INTAKE_COLUMNS
from ..session import scratch_dir
from ..streaming.intake_stream import start_intake_stream
from . import bindings as B
from . import sqlgen as S
from .q_keywords import TAX, categories_string
from .registry import query

_SQL = f"""WITH {S.N_CTE},
{S.prepared_cte(TAX)},
k AS (SELECT *, pre_label AS ttype FROM ps WHERE stage = 'kept'),
fb AS (
  SELECT url, arg_min({{'source': source, 'external_id': external_id}}, ord) AS f,
         arg_max({{'title': title, 'description': description, 'posted_date': posted_date, 'deadline': deadline,
                   'categories_str': categories_str, 'hits': hits}}, ord) AS l,
         arg_max(ttype, ord) FILTER (WHERE ttype IN ('commissioned', 'subsidy')) AS confirmed_type,
         min(ord) AS first_ord
  FROM k GROUP BY url)
SELECT row_number() OVER (ORDER BY first_ord, url) AS id, url, f.source AS source, f.external_id AS external_id,
       l.title AS title, md5(l.description) AS description_md5, l.posted_date AS posted_date, l.deadline AS deadline,
       l.categories_str AS categories,
       CASE WHEN len(l.hits) > 0 THEN CAST(to_json(l.hits) AS VARCHAR) END AS keyword_hits,
       coalesce(confirmed_type, 'unknown') AS tender_type, '1998-06-01 00:00:00' AS last_checked
FROM fb"""


@query("stream_intake", _SQL)
def stream_intake(spark, sf_dir):
    root = scratch_dir(spark, f"stream-intake-{uuid.uuid4().hex}")
    n = B.documents_intake(spark, sf_dir).select(*INTAKE_COLUMNS)
    half = B.split_point(spark, sf_dir)
    src = os.path.join(root, "incoming")
    store_root = os.path.join(root, "store")
    # each half arrives as one drop of files; each availableNow run applies the
    # new files as one micro-batch (arrival order = application order)
    for k, part in enumerate((n.filter(F.col("ord") < half), n.filter(F.col("ord") >= half)), start=1):
        part.write.parquet(os.path.join(src, f"drop-{k}"))
        q = start_intake_stream(spark, os.path.join(src, "*"), store_root, os.path.join(root, "stream-checkpoint"),
                                TAX, run_ts=B.RUN_TS, sources=B.DOC_SOURCE_PATTERN)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream failed: {q.exception()}")
    st = ST.read_store(spark, store_root)
    return st.select("id", "url", "source", "external_id", "title", F.md5("description").alias("description_md5"),
                     "posted_date", "deadline", categories_string(F.col("categories")).alias("categories"),
                     "keyword_hits", "tender_type",
                     F.date_format("last_checked", "yyyy-MM-dd HH:mm:ss").alias("last_checked"))
