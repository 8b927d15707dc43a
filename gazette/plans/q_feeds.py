"""Feed, JSON and date queries: orders rendered to feed XML, API JSON and
date strings, then read back by the source operators. The oracle states the
expected result directly from the order columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..sources import feeds as FD
from . import bindings as B
from .q_html import era_text_sql, _era_expected
from .registry import query

FEED_HOSTS = ("feeds.example",)
GRANT_HOSTS = ("grants.example",)
GRANT_PREFIX = "https://grants.example/subsidy/"
_D = "CAST(o_orderdate AS DATE)"
_K = "CAST(o_orderkey AS STRING)"


def _p2(x):
    return f"lpad(CAST({x} AS STRING), 2, '0')"


def ymd(x, sep="-", pad=True):
    m, d = (_p2(f"month({x})"), _p2(f"day({x})")) if pad else (f"CAST(month({x}) AS STRING)", f"CAST(day({x}) AS STRING)")
    return f"CAST(year({x}) AS STRING) || '{sep}' || {m} || '{sep}' || {d}"


def feed_xml_sql(dialect: str) -> str:
    """One feed document per order: RSS 2.0 for even keys, RDF for odd keys,
    Atom for keys that leave 5 when divided by 8. Some RSS documents hold a bare
    ampersand, and some a second item that is broken. Further ones hold CDATA
    sections (with an ampersand, or with markup and an item's end), a named HTML
    reference, or an item in a comment; some Atom documents prefix all elements."""
    if dialect == "spark":
        wd, mon = f"date_format({_D}, 'EEE')", f"date_format({_D}, 'MMM')"
    else:
        wd, mon = f"strftime({_D}, '%a')", f"strftime({_D}, '%b')"
    hh = _p2("o_orderkey % 24")
    rfc = f"{wd} || ', ' || {_p2(f'day({_D})')} || ' ' || {mon} || ' ' || CAST(year({_D}) AS STRING) || ' ' || {hh} || ':00:00 +0900'"
    iso = f"{ymd(_D)} || 'T' || {hh} || ':00:00+09:00'"
    link = (f"CASE o_orderkey % 9 WHEN 0 THEN 'http://feeds.example/o/' || {_K} "
            f"WHEN 3 THEN 'https://other.example/o/' || {_K} WHEN 6 THEN 'https://feeds.example:8443/o/' || {_K} "
            f"ELSE 'https://feeds.example/o/' || {_K} END")
    title = f"CASE WHEN o_orderkey % 23 = 0 THEN '  ' ELSE 'Order ' || {_K} || ' &amp; ' || o_orderpriority END"
    desc = "CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE 'Customer ' || CAST(o_custkey AS STRING) END"
    linkel = f"CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE '<link>' || {link} || '</link>' END"
    rss = (f"'<rss version=\"2.0\"><channel><title>Orders</title><item><title>' || {title} || '</title>' || {linkel} || "
           f"'<description>' || {desc} || '</description><pubDate>' || {rfc} || '</pubDate><guid>urn:o:' || {_K} || "
           f"'</guid></item>' || CASE WHEN o_orderkey % 10 = 4 THEN '<item><title>broken</titel><link>x</item>' ELSE '' END || '</channel></rss>'")
    name = "'Order ' || " + _K
    cdata = (f"replace(replace(replace({rss}, '<title>' || {name} || ' &amp; ' || o_orderpriority, '<title><![CDATA[' || {name} || ' & ' || o_orderpriority || ']]>'), "
             f"'<link>' || {link} || '</link>', '<link><![CDATA[' || {link} || ']]></link>'), '</channel>', '<!-- </rss> --></channel>')")
    markup = f"replace(replace({rss}, '<description>Customer', '<description><![CDATA[Customer</item> R&amp;D <b>'), '</description>', ']]></description>')"
    named = f"replace({rss}, '<title>Order ', '<title>Order&middot;&eacute; ')"
    draft = f"replace({rss}, '<item><title>' || {name}, '<!-- <item><title>draft</title><link>https://feeds.example/d</link></item> --><item><title>' || {name})"
    rss = (f"CASE o_orderkey % 14 WHEN 6 THEN {cdata} WHEN 8 THEN CASE WHEN o_orderkey % 31 = 0 THEN {rss} ELSE {markup} END "
           f"WHEN 10 THEN {named} WHEN 12 THEN {draft} ELSE {rss} END")
    rss = f"CASE WHEN o_orderkey % 10 = 2 AND o_orderkey % 14 <> 8 THEN replace({rss}, '&amp;', '&') ELSE {rss} END"
    atom = ("'<feed xmlns=\"http://www.w3.org/2005/Atom\"><title>Orders</title><entry><title type=\"text\">' || " + title + " || '</title>' || "
            f"CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE '<link rel=\"self\" href=\"https://feeds.example/self\"/><link href=\"' || {link} || '\"/>' END || "
            f"'<id>' || {link} || '</id><summary>' || {desc} || '</summary><published>' || {iso} || '</published></entry></feed>'")
    prefixed = f"replace(replace(replace({atom}, '<', '<a:'), '<a:/', '</a:'), 'xmlns=', 'xmlns:a=')"
    atom = f"CASE WHEN o_orderkey % 16 = 13 THEN {prefixed} ELSE {atom} END"
    rdf = ("'<rdf:RDF xmlns:rdf=\"http://www.w3.org/1999/02/22-rdf-syntax-ns#\" xmlns=\"http://purl.org/rss/1.0/\" "
           "xmlns:dc=\"http://purl.org/dc/elements/1.1/\"><channel rdf:about=\"https://feeds.example/\"><title>Orders</title>"
           f"<items><rdf:Seq><rdf:li rdf:resource=\"' || {link} || '\"/></rdf:Seq></items></channel><item rdf:about=\"' || {link} || '\">"
           f"<title>' || {title} || '</title>' || {linkel} || '<description>' || {desc} || '</description><dc:date>' || {iso} || "
           "'</dc:date></item></rdf:RDF>'")
    return f"CASE WHEN o_orderkey % 2 = 0 THEN {rss} WHEN o_orderkey % 8 = 5 THEN {atom} ELSE {rdf} END"


@query("feed_items", f"""SELECT o_orderkey AS id, CAST(0 AS INTEGER) AS pos, 'mext' AS source,
       CASE WHEN o_orderkey % 2 = 0 THEN 'urn:o:' || CAST(o_orderkey AS VARCHAR) ELSE 'https://feeds.example/o/' || CAST(o_orderkey AS VARCHAR) END AS external_id,
       CASE WHEN o_orderkey % 14 = 10 THEN 'Order·é ' ELSE 'Order ' END || CAST(o_orderkey AS VARCHAR) || ' & ' || o_orderpriority AS title,
       'https://feeds.example/o/' || CAST(o_orderkey AS VARCHAR) AS url,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CASE WHEN o_orderkey % 14 = 8 THEN 'Customer</item> R&amp;D <b> ' ELSE 'Customer ' END || CAST(o_custkey AS VARCHAR) END AS description,
       CASE WHEN o_orderkey % 24 < 9 THEN CAST(o_orderdate AS DATE) - 1 ELSE CAST(o_orderdate AS DATE) END AS posted_date,
       NULL::DATE AS deadline
FROM orders
WHERE o_orderkey % 23 <> 0 AND o_orderkey % 29 <> 0 AND o_orderkey % 9 NOT IN (0, 3, 6)""")
def feed_items(spark, sf_dir):
    o = B.spread(B.table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("id"),
                                                      F.expr(feed_xml_sql("spark")).alias("xml"))
    return FD.feed_items(FD.feed_entries(o, "xml"), FEED_HOSTS, "mext")


def json_body_sql() -> str:
    iso_z = lambda x: f"{ymd(x)} || 'T15:00:00.000Z'"
    start = (f"CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN 'soon' "
             f"WHEN o_orderkey % 8 = 0 THEN {ymd(_D, '/')} ELSE {iso_z(_D)} END")
    ident = f"CASE WHEN o_orderkey % 5 = 0 THEN {_K} ELSE '\"S' || {_K} || '\"' END"
    title = f"CASE WHEN o_orderkey % 23 = 0 THEN ' ' ELSE 'Subsidy ' || {_K} END"
    item = (f"'{{\"id\": ' || {ident} || ', \"title\": \"' || {title} || '\", \"acceptance_start_datetime\": \"' || {start} || "
            f"'\", \"acceptance_end_datetime\": \"' || {iso_z(_D + ' + 30')} || '\", \"subsidy_max_limit\": ' || "
            f"CAST(o_custkey * 1000 AS STRING) || '}}'")
    return (f"CASE o_orderkey % 8 "
            f"WHEN 0 THEN '{{\"metadata\": {{\"type\": \"list\", \"resultset\": {{\"count\": 1}}}}, \"result\": [' || {item} || ']}}' "
            f"WHEN 4 THEN '{{\"metadata\": {{\"type\": \"list\"}}, \"result\": [' || {item} || ']}}' "
            f"WHEN 1 THEN '{{\"results\": [' || {item} || ']}}' "
            f"WHEN 5 THEN '{{\"results\": [' || {item} || ']}}' "
            f"WHEN 2 THEN '{{\"result\": [], \"subsidies\": [' || {item} || ']}}' "
            f"WHEN 6 THEN '{{\"result\": [], \"data\": [' || {item} || ']}}' "
            f"ELSE '[' || {item} || ']' END")


@query("json_items", f"""SELECT o_orderkey AS id, CAST(0 AS INTEGER) AS pos, 'jgrants' AS source,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'S' || CAST(o_orderkey AS VARCHAR) END AS external_id,
       'Subsidy ' || CAST(o_orderkey AS VARCHAR) AS title,
       'https://grants.example/subsidy/' || CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'S' || CAST(o_orderkey AS VARCHAR) END AS url,
       NULL::VARCHAR AS description,
       CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS posted_date,
       CAST(o_orderdate AS DATE) + 30 AS deadline
FROM orders WHERE o_orderkey % 23 <> 0 AND o_orderkey <> 0""")
def json_items(spark, sf_dir):
    o = B.spread(B.table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("id"),
                                                      F.expr(json_body_sql()).alias("body"))
    return FD.json_items(FD.json_entries(o, "body"), GRANT_PREFIX, GRANT_HOSTS, "jgrants")


# ---- dates (H8-H11) ------------------------------------------------------------

@query("era_date", f"""SELECT o_orderkey AS id, {era_text_sql(_D).replace("STRING", "VARCHAR")} AS era_text,
       {_era_expected(_D)} AS parsed_date FROM orders""")
def era_date(spark, sf_dir):
    o = B.spread(B.table(spark, sf_dir, "orders")).select(F.col("o_orderkey").alias("id"),
                                                      F.expr(era_text_sql(_D)).alias("era_text"))
    return o.select("id", "era_text", D.era_date("era_text").alias("parsed_date"))


def row_text_sql():
    p, q = _D, _D + " + 30"
    kanji = f"CAST(year({p}) AS STRING) || '年' || CAST(month({p}) AS STRING) || '月' || CAST(day({p}) AS STRING) || '日'"
    wide = f"translate({ymd(p, '/')}, '0123456789', '０１２３４５６７８９')"
    return (f"CASE o_orderkey % 5 WHEN 0 THEN 'Open ' || {ymd(p, '/')} || ' until ' || {ymd(q, '-', False)} || ' (JST)' "
            f"WHEN 1 THEN 'Open ' || {kanji} || ' until ' || {ymd(q, '/')} "
            f"WHEN 2 THEN 'Posted ' || {ymd(p, '-', False)} || ', no deadline' "
            f"WHEN 3 THEN 'Open ' || {wide} || ' until ' || {ymd(q, '/')} ELSE 'Rolling call' END")


@query("row_dates", f"""SELECT o_orderkey AS id, {row_text_sql().replace("STRING", "VARCHAR")} AS row_text,
       CASE WHEN o_orderkey % 5 IN (0, 2, 3) THEN {_D} END AS posted_date,
       CASE WHEN o_orderkey % 5 IN (0, 1, 3) THEN {_D} + 30 END AS deadline FROM orders""")
def row_dates(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.expr(row_text_sql()).alias("row_text"))
    m = D.row_dates("row_text")
    return o.select("id", "row_text", D.row_date_value(F.get(m, 0)).alias("posted_date"),
                    D.row_date_value(F.get(m, 1)).alias("deadline"))


def lenient_text_sql():
    y, m, d = f"CAST(year({_D}) AS STRING)", f"month({_D})", f"CAST(day({_D}) AS STRING)"
    compact = f"{y} || {_p2(m)} || {_p2(f'day({_D})')}"
    name = "CASE " + m + " " + " ".join(f"WHEN {i} THEN '{n.title()}'" for i, n in enumerate(D.MONTHS, 1)) + " END"
    nth = f"CASE WHEN day({_D}) IN (1, 21, 31) THEN 'st' WHEN day({_D}) IN (2, 22) THEN 'nd' WHEN day({_D}) IN (3, 23) THEN 'rd' ELSE 'th' END"
    return (f"CASE o_orderkey % 19 WHEN 0 THEN {ymd(_D)} || 'T15:00:00.000Z' WHEN 1 THEN {ymd(_D, '/')} "
            f"WHEN 2 THEN {compact} WHEN 3 THEN {ymd(_D, '-', False)} || ' 23:59:59+09:00' "
            f"WHEN 4 THEN '' WHEN 5 THEN 'TBD' WHEN 6 THEN {ymd(_D, '.')} WHEN 7 THEN {name} || ' ' || {d} || ', ' || {y} "
            f"WHEN 8 THEN {ymd(_D, '/')} || 'T10:00' WHEN 9 THEN {compact} || 'T150000Z' "
            f"WHEN 10 THEN 'Mon, ' || {_p2(f'day({_D})')} || ' ' || substr({name}, 1, 3) || ' ' || {y} || ' 10:00:00 +0900' "
            f"WHEN 11 THEN {_p2(m)} || '/' || {_p2(f'day({_D})')} || '/' || {y} "
            f"WHEN 12 THEN CASE WHEN day({_D}) > 12 THEN {d} || '/' || {_p2(m)} || '/' || {y} ELSE {ymd(_D)} END "
            f"WHEN 14 THEN {y} || ' ' || substr({name}, 1, 3) || ' ' || {d} WHEN 15 THEN {y} || '-' || substr({name}, 1, 3) || '-' || {_p2(f'day({_D})')} "
            f"WHEN 16 THEN {d} || {nth} || ' of ' || {name} || ' ' || {y} WHEN 17 THEN {compact} || '150000' "
            f"WHEN 18 THEN substr({name}, 1, 3) || ' ' || {y} ELSE {d} END")


@query("lenient_date", f"""SELECT o_orderkey AS id, {lenient_text_sql().replace("STRING", "VARCHAR")} AS raw,
       CASE WHEN o_orderkey % 19 IN (4, 5, 13, 18) THEN NULL ELSE {_D} END AS parsed_date FROM orders""")
def lenient_date(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.expr(lenient_text_sql()).alias("raw"))
    return o.select("id", "raw", D.lenient_date("raw").alias("parsed_date"))
