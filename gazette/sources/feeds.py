"""Feeds (RSS 2.0 and RDF / RSS 1.0) and JSON API bodies held in a string
column, or read from files with ``spark.read``.

Feeds are cut into items (RSS, RDF) or entries (Atom), each parsed by Spark's
XML reader (``from_xml`` with one schema that covers the three dialects). JSON bodies go through VARIANT so that the unwrap rule (first non-empty
of result / results / subsidies / data, else a top-level list) and Python
truthiness of ids and titles are expressed in columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates as D
from ..functions import text as TX
from ..functions import urls as U

ITEM_FIELDS = ("title", "description", "pubDate", "guid", "dc:date", "updated", "published", "summary", "content", "id", "_rdf:about")
LINK = "ARRAY<STRUCT<_VALUE: STRING, _href: STRING, _rel: STRING>>"
ITEM_SCHEMA = ", ".join(f"`{f}` STRING" for f in ITEM_FIELDS) + f", link {LINK}"
# An RSS or RDF item, or an Atom entry.
ITEM_RE = r"(?s)<item[\s>].*?</item>|<entry[\s>].*?</entry>"
OPEN_ITEM_RE = r"<(item|entry)(\s[^>]*[^/])?>"
FEED_RE = r"(?i)<(rss|feed|channel|rdf:RDF)[\s>]"
# A CDATA section, a comment, or a tag with the text after it.
PIECE_RE = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|<?[^<]+|<"
# The references that XML itself knows.
XML_REFERENCE = r"&(amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9A-Fa-f]+);"
PREFIXED_ITEM = r"<([\w.-]+):(?:entry|item|feed)[\s>]"
# The namespaces whose elements feeds are made of.
ITEM_NAMESPACES = r"http://(?:www\.w3\.org/2005/Atom|purl\.org/rss/1\.0/)"


def restored(xml: Column) -> Column:
    """CDATA sections as escaped text, comments gone: what stands in them can't
    be taken for markup any more."""

    def piece(p: Column) -> Column:
        inner = F.substring(p, F.lit(10), F.length(p) - 12)
        for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            inner = F.replace(inner, F.lit(char), F.lit(ref))
        return (F.when(p.startswith("<![CDATA[") & p.endswith("]]>"), inner)
                .when(p.startswith("<!--") & p.endswith("-->"), F.lit("")).otherwise(p))

    pieces = F.transform(F.regexp_extract_all(xml, F.lit(PIECE_RE), F.lit(0)), piece)
    return F.when(xml.contains("<!"), F.array_join(pieces, "")).otherwise(xml)


def unprefixed(xml: Column) -> Column:
    """Elements of a feed whose items have a namespace prefix, without it."""

    def cut(found: Column) -> Column:
        doc, prefix = found["doc"], found["prefix"]
        bound = F.rlike(doc, F.concat(F.lit("xmlns:\\Q"), prefix, F.lit("\\E\\s*=\\s*[\"']" + ITEM_NAMESPACES)))
        plain = F.regexp_replace(doc, F.concat(F.lit("<(/?)\\Q"), prefix, F.lit("\\E:")), F.lit("<$1"))
        return F.when((prefix != "") & bound, plain).otherwise(doc)

    return D.let(xml, lambda x: D.let(F.struct(x.alias("doc"), F.regexp_extract(x, PREFIXED_ITEM, 1).alias("prefix")), cut))


def plain_feed(xml: Column) -> Column:
    """A document as items can be cut from it."""
    return unprefixed(restored(xml))


def plain_references(item: Column) -> Column:
    """HTML's named references as characters; an ampersand that starts no
    reference is taken as one."""
    kept = F.regexp_replace(item, XML_REFERENCE, "\u0002$1;")
    known = F.replace(F.replace(TX.decode_entities(kept), F.lit("&"), F.lit("&amp;")), F.lit("\u0002"), F.lit("&"))
    return F.when(item.contains("&"), known).otherwise(item)


def feed_parse(df: DataFrame, xml: str = "xml", keep=("id",)) -> DataFrame:
    """All that is read of feeds, in one pass: a row a document (pos -1: keep…,
    n_items, and error for what is no feed or breaks off within an item), and a
    row an item (keep…, pos, read, link and the ITEM fields).

    A document is cut into its items first and each is read by itself, so one
    that is malformed (``read`` is false) costs no other. CDATA sections,
    comments, HTML's references, bare ampersands and namespace prefixes are
    resolved before."""

    def cut(doc: Column) -> Column:
        return D.let(F.regexp_extract_all(F.coalesce(doc, F.lit("")), F.lit(ITEM_RE), F.lit(0)), lambda items: judged(doc, items))

    def judged(doc: Column, items: Column) -> Column:
        broken = F.regexp_replace(doc, ITEM_RE, "").rlike(OPEN_ITEM_RE)
        bad = F.coalesce(F.trim(doc), F.lit("")) == ""
        error = F.when(bad, F.lit("empty document")).when((F.size(items) == 0) & ~doc.rlike(FEED_RE), F.lit("not a feed")).when(broken, F.lit("item without end"))
        return F.struct(error.alias("error"), items.alias("items"))

    e = df.select(*keep, D.let(plain_feed(F.col(xml)), cut).alias("_d"))
    none = F.array(F.lit(None).cast("string"))
    e = e.select(*keep, F.size("_d.items").alias("n_items"), F.col("_d.error").alias("error"), F.posexplode(F.concat(none, F.col("_d.items"))).alias("pos", "item"))
    read = F.from_xml(plain_references(F.col("item")), ITEM_SCHEMA + ", _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    e = e.select(*keep, "n_items", "error", (F.col("pos") - 1).alias("pos"), read.alias("it"))
    link = F.filter("it.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    href = F.coalesce(F.get(link, 0)["_href"], F.get(F.col("it.link"), 0)["_VALUE"])
    fields = [F.col("it")[f].alias("atom_id" if f == "id" else f) for f in ITEM_FIELDS]
    return e.select(*keep, "n_items", "error", "pos", F.col("it._bad").isNull().alias("read"), href.alias("link"), *fields)


def entries_of(parsed: DataFrame) -> DataFrame:
    """The items of a parse."""
    return parsed.where("pos >= 0").drop("n_items", "error")


def status_of(parsed: DataFrame, keep=("id",)) -> DataFrame:
    """The documents of a parse: keep…, n_items, error."""
    return parsed.where("pos < 0").select(*keep, *[c for c in ("n_items",) if c in parsed.columns], "error")


def feed_entries(df: DataFrame, xml: str = "xml", keep=("id",)) -> DataFrame:
    """One row per feed item: keep…, pos, read, link and the ITEM fields."""
    return entries_of(feed_parse(df, xml, keep))


def feed_status(df: DataFrame, xml: str = "xml", keep=("id",)) -> DataFrame:
    """A row a document: keep…, n_items, error."""
    return status_of(feed_parse(df, xml, keep), keep)


def feed_items(entries: DataFrame, allowed_hosts, source: str, keep=("id",)) -> DataFrame:
    """Feed entries to intake columns (A4, B10, B3, H12): title and link
    stripped and required, link on an allowed https host without port,
    posted = published else updated (UTC calendar day), id = guid or rdf:about."""
    title, url = _feed_title_url()
    e = entries.select(*keep, "pos", title.alias("title"), url.alias("url"),
                       TX.blank_to_null(F.coalesce("description", "summary", "content")).alias("description"),
                       D.feed_date(F.coalesce("pubDate", "published"), F.coalesce(F.col("`dc:date`"), F.col("updated"))).alias("posted_date"),
                       F.coalesce(F.col("guid"), F.col("`_rdf:about`"), F.col("atom_id")).alias("external_id"))
    e = e.filter((F.col("title") != "") & (F.col("url") != "") & U.allowed(F.col("url"), allowed_hosts))
    return e.select(*keep, "pos", F.lit(source).alias("source"), "external_id", "title", "url", "description",
                    "posted_date", F.lit(None).cast("date").alias("deadline"))


def _feed_title_url() -> tuple:
    return tuple(TX.unicode_strip(F.coalesce(F.col(c), F.lit(""))) for c in ("title", "link"))


def feed_item_errors(entries: DataFrame, allowed_hosts, keep=("id",)) -> DataFrame:
    """The entries that ``feed_items`` leaves out: keep…, pos, error."""
    title, url = _feed_title_url()
    return _left_out(entries, keep, F.struct(F.col("read").alias("read"), title.alias("title"), url.alias("url")), allowed_hosts,
                     lambda x: (x["title"] != "") & (x["url"] != ""),
                     lambda x: [("malformed item", ~x["read"]), ("title", x["title"] == ""), ("url", x["url"] == "")])


def _left_out(items: DataFrame, keep, parts: Column, allowed_hosts, wanted: Callable, rules: Callable) -> DataFrame:
    """Items that aren't ``wanted`` or have no allowed url, with the first rule
    (name, condition) that holds. The rules see the ``parts`` of an item (url
    among them), each computed once: a filter on them would repeat them."""

    def error(x: Column) -> Column:
        said = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules(x)], F.lit("url not allowed"))
        return F.when(~F.coalesce(wanted(x) & U.allowed(x["url"], allowed_hosts), F.lit(False)), said)

    return items.select(*keep, "pos", D.let(parts, error).alias("error")).where(F.col("error").isNotNull())


# --------------------------------------------------------------------------
# JSON API bodies (A5)

UNWRAP_KEYS = ("result", "results", "subsidies", "data")


def _vget(v: Column, path: str, typ: str) -> Column:
    return F.call_function("try_variant_get", v, F.lit(path), F.lit(typ))


def _variant_columns(x: Column) -> dict:
    return {"_t": F.schema_of_variant(x), "_s": _vget(x, "$", "string"), "_n": _vget(x, "$", "double"),
            "_len": F.when(F.schema_of_variant(x).startswith("ARRAY"), F.size(_vget(x, "$", "array<variant>")))}


def variant_parts(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_t`` (JSON type), ``_s`` (as text) and ``_n`` (as number)
    of a VARIANT column: each is computed once and read by later checks."""
    for name, part in _variant_columns(F.col(col)).items():
        df = df.withColumn(prefix + name, part)
    return df


def variant_text(v: Column) -> Column:
    """:func:`truthy_text` of a VARIANT, its parts computed once."""
    parts = F.struct(*[part.alias(name) for name, part in _variant_columns(v).items()])
    return D.let(parts, lambda p: _truthy(p["_t"], p["_s"], p["_n"], p["_len"]))


def truthy_text(prefix: str) -> Column:
    """``str(value or '').strip()`` of a JSON value from its parts, NULL when ''."""
    return _truthy(*(F.col(prefix + p) for p in ("_t", "_s", "_n", "_len")))


def _truthy(t: Column, s: Column, num: Column, size: Column) -> Column:
    falsy = (t.isNull() | (t == "VOID") | ((t == "BOOLEAN") & (s == "false"))
             | ((t != "STRING") & (t != "BOOLEAN") & (num == 0))
             | F.coalesce(size == 0, F.lit(False)))
    txt = TX.unicode_strip(F.when(t == "BOOLEAN", F.initcap(s)).otherwise(s))
    return F.when(~falsy & (F.length(txt) > 0), txt)


def json_parse(df: DataFrame, body: str = "body", keep=("id",)) -> DataFrame:
    """All that is read of API bodies, in one pass: a row a document (pos -1:
    keep…, and error for what is no JSON or holds something else where the list
    of items is expected), and a row an item (keep…, pos, item)."""
    d = _json_lists(df, body, keep, also=("_v",))
    kind = F.schema_of_variant("_v")

    def no_list(v: Column) -> Column:
        t = F.schema_of_variant(v)
        return t.startswith("OBJECT") | (~t.startswith("ARRAY") & (t != "VOID") & ~_vget(v, "$", "string").isin("", "0", "false"))

    held = F.exists(F.array(*[_vget(F.col("_v"), f"$.{k}", "variant") for k in UNWRAP_KEYS]), lambda v: F.coalesce(no_list(v), F.lit(False)))
    other = held | (~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"))
    error = F.when(F.col("_v").isNull(), F.lit("not JSON")).when(_json_list().isNull() & other, F.lit("no list of items"))
    none = F.array(F.lit(None).cast("variant"))
    e = d.select(*keep, error.alias("error"), F.posexplode(F.concat(none, F.coalesce(_json_list(), F.array().cast("array<variant>")))).alias("pos", "item"))
    return e.withColumn("pos", F.col("pos") - 1)


def json_status(df: DataFrame, body: str = "body", keep=("id",)) -> DataFrame:
    """A row a body: keep…, error."""
    return status_of(json_parse(df, body, keep), keep)


def json_entries(df: DataFrame, body: str = "body", keep=("id",)) -> DataFrame:
    """One row per API item: keep…, pos, item (VARIANT)."""
    return _json_lists(df, body, keep).select(*keep, F.posexplode(_json_list()).alias("pos", "item"))


def _json_lists(df: DataFrame, body: str, keep, also=()) -> DataFrame:
    d = df.select(*keep, F.try_parse_json(F.col(body)).alias("_v"))
    # staged, so that each key is looked up once
    return d.select(*keep, *also, *[_vget(F.col("_v"), f"$.{k}", "array<variant>").alias(f"_a{i}") for i, k in enumerate(UNWRAP_KEYS)],
                 F.when(F.schema_of_variant("_v").startswith("ARRAY"), _vget(F.col("_v"), "$", "array<variant>")).alias("_top"))


def _json_list() -> Column:
    return F.coalesce(*[F.when(F.size(f"_a{i}") > 0, F.col(f"_a{i}")) for i in range(len(UNWRAP_KEYS))], F.col("_top"))


def json_items(entries: DataFrame, url_prefix: str, allowed_hosts, source: str, keep=("id",),
               id_field: str = "id", title_field: str = "title",
               start_field: str = "acceptance_start_datetime",
               end_field: str = "acceptance_end_datetime") -> DataFrame:
    """API items to intake columns: blank id or title dropped, URL built from
    the id and checked against the allowlist, lenient dates, no description."""
    e = _json_fields(entries, keep, {"_id": id_field, "_ti": title_field, "_st": start_field, "_en": end_field})
    e = e.select(*keep, "pos", truthy_text("_id").alias("external_id"), truthy_text("_ti").alias("title"),
                 truthy_text("_st").alias("_start"), truthy_text("_en").alias("_end"))
    e = e.filter(F.col("external_id").isNotNull() & F.col("title").isNotNull())
    e = e.select(*keep, "pos", "external_id", "title", D.lenient_date("_start").alias("posted_date"),
                 D.lenient_date("_end").alias("deadline"))
    e = e.withColumn("url", F.concat(F.lit(url_prefix), F.col("external_id")))
    e = e.filter(U.allowed(F.col("url"), allowed_hosts))
    return e.select(*keep, "pos", F.lit(source).alias("source"), "external_id", "title", "url",
                    F.lit(None).cast("string").alias("description"), "posted_date", "deadline")


def _json_fields(entries: DataFrame, keep, fields: dict) -> DataFrame:
    e = entries.select(*keep, "pos", *[_vget(F.col("item"), f"$.{f}", "variant").alias(a) for a, f in fields.items()])
    for a in fields:
        e = variant_parts(e, a, a)
    return e


def json_item_errors(entries: DataFrame, url_prefix: str, allowed_hosts, keep=("id",), id_field: str = "id",
                     title_field: str = "title") -> DataFrame:
    """The items that ``json_items`` leaves out: keep…, pos, error."""
    ident, title = (variant_text(_vget(F.col("item"), f"$.{f}", "variant")) for f in (id_field, title_field))
    parts = D.let(F.struct(ident.alias("id"), title.alias("title")),
                  lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title"), F.concat(F.lit(url_prefix), x["id"]).alias("url")))
    return _left_out(entries, keep, parts, allowed_hosts, lambda x: x["id"].isNotNull() & x["title"].isNotNull(),
                     lambda x: [("id", x["id"].isNull()), ("title", x["title"].isNull())])
