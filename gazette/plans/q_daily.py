"""The flagship query: the daily run over N into an empty store, scored by
the rule scorer, published as the active board."""

from __future__ import annotations

import datetime as _dt

from .. import constants as K
from ..operators import scoring as SC
from ..operators import store as ST
from . import bindings as B
from . import sqlgen as S
from .daily import daily_run
from .q_keywords import TAX
from .registry import query

FLAGSHIP_AS_OF = _dt.date(1997, 6, 1)
CATS = list(B.CATEGORY_LABELS)


def flagship_run(spark, sf_dir):
    return daily_run(B.documents_intake(spark, sf_dir), TAX, ST.empty_store(spark), B.RUN_TS, FLAGSHIP_AS_OF,
                     CATS, B.CATEGORY_LABELS, scorer_factory=SC.rule_scorer_factory,
                     sources=B.DOC_SOURCE_PATTERN, reuse_prepared=False)   # only the board is read


def flagship(spark, sf_dir):
    from ..session import apply_engine_conf
    apply_engine_conf(spark)
    board = flagship_run(spark, sf_dir).board
    return board.select("board_rank", "id", "url", "title", "deadline", "score", "tender_type", "badge", "band", "tags")


_AS_OF = f"DATE '{FLAGSHIP_AS_OF.isoformat()}'"
_TAGS = "concat_ws(' ', " + ", ".join(
    f"CASE WHEN contains(coalesce(categories_str, ''), {S.lit(c + ':')}) THEN {S.lit(B.CATEGORY_LABELS[c])} END"
    for c in CATS) + ")"
_BADGE = f"""CASE WHEN deadline IS NULL THEN NULL
     WHEN date_diff('day', {_AS_OF}, deadline) < 0 THEN {S.lit(K.BADGE_EXPIRED)}
     WHEN date_diff('day', {_AS_OF}, deadline) = 0 THEN {S.lit(K.BADGE_TODAY)}
     WHEN date_diff('day', {_AS_OF}, deadline) <= 7
          THEN {S.lit(K.BADGE_DAYS_PREFIX)} || CAST(date_diff('day', {_AS_OF}, deadline) AS VARCHAR) || {S.lit(K.BADGE_DAYS_SUFFIX)}
     ELSE strftime(deadline, '%m/%d') || {S.lit(K.BADGE_DATE_SUFFIX)} END"""


@query("daily_board", f"""WITH {S.N_CTE},
{S.prepared_cte(TAX)},
k AS (SELECT *, pre_label AS ttype FROM ps WHERE stage = 'kept'),
fb AS (
  SELECT url, arg_max({{'title': title, 'description': description, 'deadline': deadline,
                       'categories_str': categories_str}}, ord) AS l,
         arg_max(ttype, ord) FILTER (WHERE ttype IN ('commissioned', 'subsidy')) AS confirmed_type,
         min(ord) AS first_ord
  FROM k GROUP BY url),
st AS (SELECT row_number() OVER (ORDER BY first_ord, url) AS id, url, l.title AS title, l.description AS description,
              l.deadline AS deadline, l.categories_str AS categories_str,
              coalesce(confirmed_type, 'unknown') AS tender_type FROM fb),
sc AS (SELECT *, length({S.sanitise("title", 300)}) AS lt, length({S.sanitise("description", 800)}) AS ld FROM st),
m AS (SELECT id, url, title, deadline, categories_str,
             CASE WHEN lt % 13 = 0 OR ld % 17 = 0 THEN NULL ELSE CAST((lt + ld) % 11 AS DOUBLE) END AS score,
             CASE WHEN lt % 13 = 0 OR ld % 17 = 0 OR (lt + 2 * ld) % 3 = 2 THEN tender_type
                  WHEN (lt + 2 * ld) % 3 = 0 THEN 'commissioned' ELSE 'subsidy' END AS tender_type
      FROM sc),
a AS (SELECT *, row_number() OVER (ORDER BY deadline ASC NULLS LAST, score DESC NULLS LAST, id DESC) AS board_rank
      FROM m WHERE (deadline IS NULL OR deadline >= {_AS_OF}) AND score IS NOT NULL AND score >= 5
        AND tender_type IS DISTINCT FROM 'subsidy')
SELECT board_rank, id, url, title, deadline, score, tender_type, {_BADGE} AS badge,
       CASE WHEN score >= 8 THEN 'high' WHEN score >= 5 THEN 'mid' ELSE 'low' END AS band, {_TAGS} AS tags
FROM a""")
def daily_board(spark, sf_dir):
    return flagship(spark, sf_dir)
