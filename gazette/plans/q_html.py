"""HTML source queries over ``pages`` (and detail pages rendered from orders)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import urls as U
from ..operators.ordering import keep_first
from ..sources import html as H
from . import bindings as B
from . import sqlgen as S
from .registry import query

HREF_PATTERN = r"^/([^/?#]+)$"
URL_TEMPLATE_JAVA = "/topic/$1"
URL_TEMPLATE_RE2 = "/topic/\\1"
CONTAINERS = "nav ul li"
ALLOWED_HOSTS = ("blog.tionsh.example.net", "thther.example.org", "m.ththth.example.net",
                 "blog.ththan.example.net")

# What the oracle reads the anchors of the test pages with: they are all of the
# one plain form. The engine gets other forms of the same anchors.
PLAIN_ANCHOR = '(?s)<a href="([^"]*)">(.*?)</a>'
ANCHOR_FORMS_SQL = """CASE page_id % 5
  WHEN 1 THEN replace(html, '<a href="', '<a data-href="/no.html" class="x" HREF = "')
  WHEN 2 THEN regexp_replace(html, '<a href="([^"]*)"', concat('<A href=', chr(39), '$1', chr(39), ' title="t"'))
  WHEN 3 THEN regexp_replace(html, '<a href="([^" >]*)"', '<a\n href=$1')
  WHEN 4 THEN regexp_replace(html, '<a href="/([^"]*)"', '<a id=1 href="&#47;$1"')
  ELSE html END"""

_ANCHORS_SQL = f"""a0 AS (
  SELECT page_id, url, regexp_extract_all(html, {S.lit(PLAIN_ANCHOR)}, 1) AS hrefs,
         regexp_extract_all(html, {S.lit(PLAIN_ANCHOR)}, 2) AS inners FROM pages),
a1 AS (SELECT page_id, url, unnest(range(len(hrefs))) AS pos, hrefs, inners FROM a0),
an AS (SELECT page_id, url, pos, hrefs[pos + 1] AS href, {S.node_text_stripped("inners[pos + 1]")} AS title FROM a1)"""


@query("link_listing", f"""WITH {_ANCHORS_SQL},
l AS (
  SELECT page_id, pos, regexp_extract(url, {S.lit(S.ORIGIN_RE)}, 1) ||
         regexp_replace(href, {S.lit(HREF_PATTERN)}, {S.lit(URL_TEMPLATE_RE2)}) AS link, title
  FROM an WHERE regexp_matches(href, {S.lit(HREF_PATTERN)}) AND title <> '')
SELECT link, arg_min({{'page_id': page_id, 'pos': pos, 'title': title}}, page_id * 1000000 + pos).page_id AS page_id,
       arg_min({{'page_id': page_id, 'pos': pos, 'title': title}}, page_id * 1000000 + pos).pos AS pos,
       arg_min({{'page_id': page_id, 'pos': pos, 'title': title}}, page_id * 1000000 + pos).title AS title
FROM l GROUP BY link""")
def link_listing(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").withColumn("html", F.expr(ANCHOR_FORMS_SQL))
    out = H.link_listing(pages, HREF_PATTERN, URL_TEMPLATE_JAVA)
    return out.select("link", "page_id", F.col("pos").cast("long").alias("pos"), "title")


# URL defects spliced into page URLs: a port, upper case, a space, user info.
URL_SPLICE_SQL = """CASE page_id % 10
  WHEN 0 THEN replace(replace(replace(url, '.com/', '.com:8443/'), '.net/', '.net:8443/'), '.org/', '.org:8443/')
  WHEN 5 THEN upper(url)
  WHEN 7 THEN replace(url, '/en/', '/en /')
  WHEN 3 THEN replace(url, '://', '://user@')
  ELSE url END"""

_HOSTS = "(" + ", ".join(S.lit(h) for h in ALLOWED_HOSTS) + ")"


@query("url_allowlist", f"""WITH u0 AS (SELECT page_id, {URL_SPLICE_SQL} AS u FROM pages),
u1 AS (SELECT page_id, u, NOT regexp_matches(u, '[ <>"{{}}|\\\\^`]') AND regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://') AS valid,
              regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS auth FROM u0),
u2 AS (SELECT page_id, u,
              CASE WHEN valid THEN lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\\-]*)://', 1)) END AS scheme,
              CASE WHEN valid THEN lower(regexp_replace(regexp_replace(auth, '^.*@', ''), ':[0-9]*$', '')) END AS host,
              valid AND regexp_matches(regexp_replace(auth, '^.*@', ''), ':[0-9]+$') AS has_port FROM u1)
SELECT page_id, u AS url, scheme, host, has_port,
       coalesce(scheme = 'https' AND host IN {_HOSTS} AND NOT has_port, FALSE) AS allowed,
       coalesce(host IN {_HOSTS}, FALSE) AS allowed_host_only
FROM u2""")
def url_allowlist(spark, sf_dir):
    p = B.table(spark, sf_dir, "pages").select("page_id", F.expr(URL_SPLICE_SQL).alias("url"))
    return p.select("page_id", "url", U.scheme("url").alias("scheme"), U.host("url").alias("host"),
                    U.has_port("url").alias("has_port"), U.allowed("url", ALLOWED_HOSTS).alias("allowed"),
                    U.allowed("url", ALLOWED_HOSTS, require_https=False, forbid_port=False).alias("allowed_host_only"))


# Rows with two dates, rows whose first date is in a form that is matched but
# not read, and pages without rows, of whose anchors some point into the listing.
ROW_FORMS_SQL = """CASE
  WHEN page_id % 5 = 2 THEN replace(replace(replace(html, '<li><a href="/t', '<li><a href="/koubo/t'), '<li>', '<p>'), '</li>', '</p>')
  WHEN page_id % 4 = 1 THEN replace(html, '</a></li>', '</a> 2024/4/' || CAST(1 + page_id % 28 AS STRING) || ' - 2024-05-' || CAST(1 + page_id % 28 AS STRING) || '</li>')
  WHEN page_id % 4 = 3 THEN replace(html, '</a></li>', '</a> 2024年4月2日 2024/06/30</li>')
  ELSE html END"""
_DAY = "CAST(1 + page_id % 28 AS BIGINT)"


@query("container_rows", f"""WITH h AS (SELECT page_id, url, regexp_extract({ROW_FORMS_SQL}, '(?s)<nav>(.*?)</nav>', 1) AS nav, page_id % 5 = 2 AS plain FROM pages),
c0 AS (
  SELECT page_id, url, plain,
         CASE WHEN plain THEN regexp_extract_all(nav, {S.lit(PLAIN_ANCHOR)}, 0) ELSE regexp_extract_all(nav, '(?s)<li>(.*?)</li>', 1) END AS lis FROM h),
c1 AS (SELECT page_id, url, plain, unnest(range(len(lis))) AS pos, lis FROM c0),
c2 AS (SELECT page_id, url, plain, pos, regexp_extract(lis[pos + 1], {S.lit(PLAIN_ANCHOR)}, 1) AS href,
              {S.node_text_stripped(f"regexp_extract(lis[pos + 1], {S.lit(PLAIN_ANCHOR)}, 2)")} AS title,
              regexp_matches(lis[pos + 1], {S.lit(PLAIN_ANCHOR)}) AS has_link FROM c1),
c3 AS (SELECT page_id, pos, regexp_extract(url, {S.lit(S.ORIGIN_RE)}, 1) || href AS link, title,
              CASE WHEN NOT plain AND page_id % 4 = 1 THEN make_date(2024, 4, {_DAY}) END AS posted_date,
              CASE WHEN NOT plain AND page_id % 4 = 1 THEN make_date(2024, 5, {_DAY})
                   WHEN NOT plain AND page_id % 4 = 3 THEN DATE '2024-06-30' END AS deadline
       FROM c2 WHERE has_link AND href <> '' AND title <> '' AND (NOT plain OR contains(href, '/koubo/') OR contains(href, '/research/'))),
c4 AS (SELECT link, arg_min({{'page_id': page_id, 'pos': pos, 'title': title, 'posted_date': posted_date, 'deadline': deadline}},
                            page_id * 1000000 + pos) AS f FROM c3 GROUP BY link)
SELECT link, f.page_id AS page_id, f.pos AS pos, f.title AS title, f.posted_date AS posted_date, f.deadline AS deadline FROM c4""")
def container_rows(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").withColumn("html", F.expr(ROW_FORMS_SQL))
    ev = H.container_rows(pages, CONTAINERS).filter(F.col("kind").isNotNull())
    # anchor-only rows (fallback listing) must point into the listing area
    ev = ev.filter(H.fallback_anchor_filter())
    link = U.resolve(F.col("href"), F.col("url"))
    ev = ev.select("page_id", "pos", "kind", "url", link.alias("link"), "title", "row_text")
    ev = ev.filter(F.col("link").isNotNull() & (U.host("link") == U.host("url")) & (F.col("title") != ""))
    dates = D.row_dates(F.col("row_text"))
    ev = ev.select("page_id", "pos", "link", "title",
                   F.when(F.col("kind") == "row", D.row_date_value(F.get(dates, 0))).alias("posted_date"),
                   F.when(F.col("kind") == "row", D.row_date_value(F.get(dates, 1))).alias("deadline"),
                   F.struct("page_id", "pos").alias("_ord"))
    out = keep_first(ev, "link", "_ord").drop("_ord")
    return out.select("link", "page_id", F.col("pos").cast("long").alias("pos"), "title", "posted_date", "deadline")


# ---- detail pages rendered from orders (dt/dd with era dates) -----------------

def era_text_sql(date_expr: str) -> str:
    """Era date text with full-width digits; the day is impossible for every 19th key."""
    fw = "'０１２３４５６７８９'"
    era = "CASE o_orderkey % 3 WHEN 0 THEN '平成' WHEN 1 THEN '令和' ELSE '昭和' END"
    day = f"CASE WHEN o_orderkey % 19 = 0 THEN 32 ELSE day({date_expr}) END"
    return (f"{era} || translate(CAST(year({date_expr}) - 1988 AS STRING), '0123456789', {fw}) || '年' || "
            f"translate(CAST(month({date_expr}) AS STRING), '0123456789', {fw}) || '月' || "
            f"translate(CAST({day} AS STRING), '0123456789', {fw}) || '日(金)'")


_D = "CAST(o_orderdate AS DATE)"
DETAIL_HTML_SQL = f"""'<html><body><h1>Notice ' || CAST(o_orderkey AS STRING) || '</h1>' ||
  CASE WHEN o_orderkey % 5 = 0 THEN '<p>no dates</p>' ELSE
    '<dl><dt>公告日</dt><dd><b>' || {era_text_sql(_D)} || '</b></dd>' ||
    '<dt>質問期限</dt><dd>' || {era_text_sql(_D + " + 10")} || '</dd>' ||
    CASE WHEN o_orderkey % 7 = 0 THEN '<dt>公告日</dt><dd>' || {era_text_sql(_D + " + 1")} || '</dd>' ELSE '' END ||
    '<dt> 期限 </dt><dd>' || {era_text_sql(_D + " + 20")} || '</dd>' ||
    '<dt>期限</dt><dd><font> ' || {era_text_sql(_D + " + 30")} || ' </font></dd>' ||
    CASE WHEN o_orderkey % 4 = 0 THEN '<dt>期限<br></dt><dd>' || {era_text_sql(_D + " + 40")} || '</dd>' ELSE '' END ||
    '</dl>' END || '</body></html>'"""


def _era_expected(date_expr: str) -> str:
    off = "CASE o_orderkey % 3 WHEN 0 THEN 1988 WHEN 1 THEN 2018 ELSE 1925 END"
    return (f"CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE "
            f"TRY(make_date(CAST({off} + year({date_expr}) - 1988 AS BIGINT), month({date_expr}), day({date_expr}))) END")


@query("definition_fields", f"""SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_era_expected(_D)} END AS posted_date,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_era_expected(_D + " + 30")} END AS deadline
FROM orders""")
def definition_fields(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    pages = B.spread(o).select(F.col("o_orderkey").alias("id"), F.expr(DETAIL_HTML_SQL).alias("html"))
    f = H.definition_fields(H.definition_pairs(pages, keep=("id",)), "id")
    return f.select("id", D.era_date("first_value").alias("posted_date"), D.era_date("last_value").alias("deadline"))


def splice_dates(kind: str) -> str:
    """A definition list with two era dates before </body>, by page_id."""
    base = "DATE '2020-01-01' + CAST(page_id % 300 AS INT)"
    if kind == "spark":
        era = lambda n: (f"'令和' || CAST(year({base} + {n}) - 2018 AS STRING) || '年' || CAST(month({base} + {n}) AS STRING) || '月' || "  # noqa: E731
                         f"CAST(day({base} + {n}) AS STRING) || '日'")
        return (f"CASE WHEN page_id % 3 = 0 THEN html ELSE replace(html, '</body>', '<dl><dt>公告日</dt><dd>' || {era(0)} || "
                f"'</dd><dt>期限</dt><dd>' || {era(30)} || '</dd></dl></body>') END")
    return base


_BASE = splice_dates("duckdb")


def _expected_date(n: int) -> str:
    return f"CASE WHEN p.page_id % 3 = 0 OR NOT contains(p.html, '</body>') THEN NULL ELSE CAST({_BASE.replace('page_id', 'p.page_id')} + {n} AS DATE) END"


DETAIL_SQL = f"""WITH l AS (SELECT page_id, url, {S.node_text_stripped("regexp_extract(html, " + S.lit(H.TITLE_RE) + ", 1)")} AS title FROM pages),
d AS (SELECT p.url, arg_min({{'x': {_expected_date(0)}, 'y': {_expected_date(30)}}}, p.page_id) AS v
      FROM pages p WHERE regexp_matches(p.html, '(?i)</html>\\s*$') GROUP BY p.url)
SELECT l.page_id, l.url, l.title, nullif(split_part(regexp_replace(l.url, '/+$', ''), '/', -1), '') AS external_id,
       'jst' AS source, v.x AS posted_date, v.y AS deadline
FROM l JOIN d ON l.url = d.url"""


def detail_rows(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").withColumn("html", F.expr(splice_dates("spark")))
    listing = pages.select("page_id", "url", H.page_title("html").alias("title"))
    # pages that failed to load (incomplete) or to parse are quarantined, not joined
    fetched = pages.filter(F.col("html").rlike(r"(?i)</html>\s*$")).select("page_id", "url", "html")
    fields = H.definition_fields(H.definition_pairs(fetched, keep=("url", "page_id")), ["url", "page_id"])
    details = H.first_good_page(fields).select(
        "url", D.era_date("first_value").alias("posted_date"), D.era_date("last_value").alias("deadline"))
    j = listing.join(details, "url", "inner")
    return j.select("page_id", "url", "title", U.last_path_segment("url").alias("external_id"), F.lit("jst").alias("source"),
                    "posted_date", "deadline")


@query("detail_join", f"SELECT url, title, external_id, source, posted_date, deadline FROM ({DETAIL_SQL}) j")
def detail_join(spark, sf_dir):
    return detail_rows(spark, sf_dir).drop("page_id")
