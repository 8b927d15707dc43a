"""HTML listings and detail pages held in a ``(key…, url, html)`` DataFrame.

Two paths:

* native — anchors and ``<title>`` by regular expressions in the JVM
  (``regexp_extract_all`` + ``posexplode``). Enough for flat markup such as
  anchor lists, and it stays inside whole-stage codegen.
* events — the standard library's ``html.parser`` inside ``mapInPandas``, for
  rules that depend on nesting: definition lists (``dt``/``dd`` pairs) are read
  as the tags go by, container rows (rows matched by simple CSS selectors, first
  anchor, row text) from a small tree. Flat event rows come out; all the rules
  after that (dedup, first/last, dates, URLs) are columns again.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import constants as K
from ..functions import text as TX
from ..functions import urls as U

# An anchor with a double-quoted (1), single-quoted (2) or bare (3) href, and
# its inner HTML (4). A blank stands before ``href``: data-href is another name.
ANCHOR_RE = r"""(?is)<a(?:\s[^>]*?)?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
_MARK = "\u0001"


def node_text_stripped(inner: Column) -> Column:
    """Text of an HTML fragment with each text piece stripped and the pieces
    joined by '' (as ``get_text(strip=True)``), on the JVM."""
    x = F.regexp_replace(inner, "<[^>]*>", _MARK)
    x = TX.decode_entities(x)
    x = F.regexp_replace(x, f"{TX.PY_SPACE_CLASS}*{_MARK}{TX.PY_SPACE_CLASS}*", "")
    return TX.unicode_strip(x)


def anchors(pages: DataFrame, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    """One row per anchor with an href: keep…, pos, href, title."""
    part = lambda i: F.regexp_extract_all(F.col(html), F.lit(ANCHOR_RE), F.lit(i))
    found = F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), part(4).alias("inner"))
    a = pages.select(*keep, F.posexplode(found).alias("pos", "x"))
    href = F.concat(*[F.coalesce(F.col(f"x.{c}"), F.lit("")) for c in "abc"])  # one of them at most has text
    return a.select(*keep, "pos", TX.decode_entities(href).alias("href"), node_text_stripped(F.col("x.inner")).alias("title"))


def page_title(html: Column | str) -> Column:
    c = F.col(html) if isinstance(html, str) else html
    return node_text_stripped(F.regexp_extract(c, TITLE_RE, 1))


def link_listing(pages: DataFrame, href_pattern: str, url_template: str,
                 html: str = "html", base: str = "url", key: str = "page_id") -> DataFrame:
    """Listing links (A1): anchors whose href matches ``href_pattern``, clean
    URL from ``url_template`` (``$1``… refer to the pattern's groups) resolved
    against the page URL; empty titles dropped before the dedup; first
    occurrence per URL kept in (page, position) order."""
    from ..operators.ordering import keep_first
    a = anchors(pages, html, keep=(key, base))
    a = a.filter(F.col("href").rlike(href_pattern))
    clean = F.regexp_replace(F.regexp_extract(F.col("href"), href_pattern, 0), href_pattern, url_template)
    a = a.select(key, "pos", U.resolve(clean, F.col(base)).alias("link"), "title")
    a = a.filter(F.col("title") != "").withColumn("_ord", F.struct(key, "pos"))
    return keep_first(a, "link", "_ord").drop("_ord")


# --------------------------------------------------------------------------
# tree path

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr", "basefont", "bgsound", "frame", "keygen", "menuitem", "spacer"}


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent


class _Builder(HTMLParser):
    """Start tags push, end tags pop to the nearest open element of that name
    (unmatched end tags are ignored), void elements never hold children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict((k, v if v is not None else "") for k, v in attrs), self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, dict((k, v or "") for k, v in attrs), self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse_tree(doc: str) -> _Node:
    b = _Builder()
    b.feed(doc or "")
    b.close()
    return b.root


def _all(node):
    """Everything below a node in document order; depth costs no recursion."""
    open_ = [iter(node.children)]
    while open_:
        for ch in open_[-1]:
            yield ch
            if isinstance(ch, _Node):
                open_.append(iter(ch.children))
                break
        else:
            open_.pop()


def _walk(node):
    return (ch for ch in _all(node) if isinstance(ch, _Node))


def _texts(node):
    return (ch for ch in _all(node) if not isinstance(ch, _Node))


def text_of(node, sep: str = "", strip: bool = False) -> str:
    parts = _texts(node)
    if strip:
        parts = [p.strip() for p in parts]
        parts = [p for p in parts if p]
    return sep.join(parts)


def _parse_simple(sel: str):
    sel = sel.strip()
    tag, _, cls = sel.partition(".")
    classes = [c for c in cls.split(".") if c] if cls else []
    return (tag or None, classes)


def _matches_simple(node, simple):
    tag, classes = simple
    if tag and node.tag != tag:
        return False
    have = node.attrs.get("class", "").split()
    return all(c in have for c in classes)


def _matches(node, chain):
    """Descendant-combinator selector ``a b c``: node matches c, ancestors b then a."""
    if not _matches_simple(node, chain[-1]):
        return False
    i, p = len(chain) - 2, node.parent
    while i >= 0 and p is not None:
        if p.tag != "[document]" and _matches_simple(p, chain[i]):
            i -= 1
        p = p.parent
    return i < 0


def compile_selectors(selectors: str):
    """'table.x tr, ul.x li, .item' -> list of descendant chains."""
    return [[_parse_simple(s) for s in part.split()] for part in selectors.split(",") if part.strip()]


ROW_EVENT = T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("href", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("row_text", T.StringType()),
])

PAIR_EVENT = T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("dt", T.StringType()),
    T.StructField("dd", T.StringType()),
])


def container_events(doc: str, chains) -> list:
    """Rows of a listing page (A2): for each element matching a selector, in
    document order: its first anchor with an href, the anchor text (pieces
    stripped, joined by ''), the row text (raw pieces joined by ' '). A row
    that is itself an anchor is an 'anchor' event without row text. With no
    matching row on the page, every anchor with an href is an 'anchor' event."""
    root = parse_tree(doc)
    rows = [n for n in _walk(root) if any(_matches(n, c) for c in chains)]
    fallback = not rows
    if fallback:
        rows = [n for n in _walk(root) if n.tag == "a" and "href" in n.attrs]
    out = []
    for i, el in enumerate(rows):
        if el.tag == "a":
            out.append((i, "anchor", el.attrs.get("href", ""), text_of(el, "", True), None))
            continue
        link = next((n for n in _walk(el) if n.tag == "a" and "href" in n.attrs), None)
        if link is None:
            continue
        out.append((i, "row", link.attrs["href"], text_of(link, "", True), text_of(el, " ")))
    return out


class _Open:
    """An element that is still open: what a ``dt`` needs to be one string, and
    the pairs of it that wait for a ``dd`` among its children."""

    __slots__ = ("tag", "n", "only", "pair", "waiting", "answers", "start")

    def __init__(self, tag, pair=None, answers=(), start=0):
        self.tag, self.n, self.only = tag, 0, None
        self.pair, self.waiting, self.answers, self.start = pair, [], answers, start


class _Pairs(HTMLParser):
    """Definition pairs as the tags go by; no tree is built. Tags open and close
    as in ``_Builder``. Kept are the elements now open, the pairs found and the
    text pieces of the ``dd`` elements now open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [_Open("[document]")]
        self.count = {}                 # open elements by name
        self.pairs = []                 # [string of dt, text of dd]
        self.pieces, self.reading = [], 0

    def handle_starttag(self, tag, attrs):
        up = self.open[-1]
        up.n += 1
        if tag in VOID:
            return
        answers, pair = (), None
        if tag == "dd" and up.waiting:
            answers, up.waiting = up.waiting, []
            self.reading += 1
        elif tag == "dt":
            pair = [None, None]
            self.pairs.append(pair)
        self.open.append(_Open(tag, pair, answers, len(self.pieces)))
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        up = self.open[-1]
        up.n += 1
        if tag == "dd":
            for pair in up.waiting:
                pair[1] = ""
            up.waiting = []

    def handle_data(self, data):
        up = self.open[-1]
        up.n += 1
        up.only = data
        if self.reading:
            piece = data.strip()
            if piece:
                self.pieces.append(piece)

    def handle_endtag(self, tag):
        if not self.count.get(tag):
            return
        while self.leave() != tag:
            pass

    def leave(self) -> str:
        """The innermost element ends."""
        el, up = self.open.pop(), self.open[-1]
        self.count[el.tag] -= 1
        only = el.only if el.n == 1 else None
        up.only = only
        if el.pair is not None and only is not None:
            el.pair[0] = only
            up.waiting.append(el.pair)
        if el.answers:
            text = " ".join(self.pieces[el.start:])
            for pair in el.answers:
                pair[1] = text
            self.reading -= 1
            if not self.reading:
                self.pieces = []
        return el.tag

    def close(self):
        super().close()
        while len(self.open) > 1:
            self.leave()


def definition_events(doc: str) -> list:
    """Definition pairs (A3): for each ``dt`` whose single string exists, in
    document order: that string and the text of the next following sibling
    ``dd`` (pieces stripped, joined by ' '), or None without one."""
    if not doc:
        return []
    p = _Pairs()
    p.feed(doc)
    p.close()
    found = [(s, dd) for s, dd in p.pairs if s is not None]
    return [(i, s, dd) for i, (s, dd) in enumerate(found)]


def _events(df: DataFrame, html: str, keep: list, event_schema: T.StructType, fn) -> DataFrame:
    in_df = df.select(*keep, html)
    schema = T.StructType([in_df.schema[k] for k in keep] + [T.StructField("ok", T.BooleanType())]
                          + event_schema.fields)
    names = [f.name for f in event_schema.fields]

    cols = keep + [html]

    def run(batches):
        for pdf in batches:
            out = {c: [] for c in keep + ["ok"] + names}
            for vals in zip(*(pdf[c] for c in cols)):
                try:
                    evs = fn(vals[-1])
                    ok = True
                except Exception:        # a page that cannot be parsed is reported, not fatal
                    evs, ok = [], False
                # one marker row per page, so pages without events are kept
                n = 1 + len(evs)
                for c, v in zip(keep, vals[:-1]):
                    out[c].extend([v] * n)
                out["ok"].extend([ok] * n)
                for i, c in enumerate(names):
                    out[c].append(None)
                    out[c].extend(ev[i] for ev in evs)
            yield pd.DataFrame(out)
    return in_df.mapInPandas(run, schema)


def container_rows(df: DataFrame, selectors: str, html: str = "html", keep=("page_id", "url")) -> DataFrame:
    chains = compile_selectors(selectors)
    return _events(df, html, list(keep), ROW_EVENT, lambda d: container_events(d, chains))


def definition_pairs(df: DataFrame, html: str = "html", keep=("page_id",)) -> DataFrame:
    """Pages without a dt tag are told in the JVM and not sent to be parsed."""
    some = df.withColumn(html, F.when(F.col(html).rlike("(?i)<dt"), F.col(html)))
    return _events(some, html, list(keep), PAIR_EVENT, definition_events)


def fallback_anchor_filter(href_parts=K.FALLBACK_HREF_PARTS):
    """Row events pass; anchor-only events (no listing rows on the page) need
    one of ``href_parts`` in their href (B4)."""
    ok = F.col("kind") == "row"
    for part in href_parts:
        ok = ok | F.col("href").contains(part)
    return ok


def definition_fields(pairs: DataFrame, key, first_label: str = K.POSTED_LABEL,
                      last_label: str = K.DEADLINE_LABEL) -> DataFrame:
    """Per page: dd of the first dt == first_label, dd of the last dt == last_label
    (dt text compared after a Unicode strip). Pages without pairs give NULLs."""
    keys = [key] if isinstance(key, str) else list(key)
    dt = TX.unicode_strip(F.col("dt"))
    # other pairs are not sorted; the marker row (without a position) keeps a page
    p = pairs.withColumn("_dt", dt).where(F.col("pos").isNull() | F.col("_dt").isin(first_label, last_label))
    first = F.min_by(F.when(F.col("_dt") == first_label, F.struct("dd")),
                     F.when(F.col("_dt") == first_label, F.col("pos")))
    last = F.max_by(F.when(F.col("_dt") == last_label, F.struct("dd")),
                    F.when(F.col("_dt") == last_label, F.col("pos")))
    return p.groupBy(*keys).agg(F.bool_and("ok").alias("ok"), first.alias("_f"), last.alias("_l")) \
        .select(*keys, "ok", F.col("_f.dd").alias("first_value"), F.col("_l.dd").alias("last_value"))


def first_good_page(fields: DataFrame, url: str = "url", page: str = "page_id") -> DataFrame:
    """Of the pages that hold one url, the first that was read well."""
    from ..operators.ordering import keep_first
    return keep_first(fields.filter("ok"), url, page)


def bad_pages(fields: DataFrame, url: str = "url") -> DataFrame:
    """Pages that could not be read, as (url, error)."""
    return fields.filter(~F.col("ok")).select(url, F.lit("page could not be parsed").alias("error"))
