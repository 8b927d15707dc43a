import json
import random

from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions import urls as U
from gazette.sources import feeds as FD
from gazette.sources import html as H

LISTING = """<html><body><ul>
<li><a href="calls/12_2031_5.html">Survey of grid stability　</a></li>
<li><a href="calls/12_2031_6.html"> <b>Reactor</b> study </a></li>
<li><a href="calls/12_2031_5.html">Duplicate entry</a></li>
<li><a href="/about.html">About</a></li>
<li><a href="calls/1_2_3.htm">Wrong suffix</a></li>
<li><a href="calls/9_2026_1.html">   </a></li>
<li><a href="calls/9_2026_1.html">Late title</a></li>
</ul></body></html>"""


def test_link_listing(spark):
    pages = spark.createDataFrame([(1, "https://proc.example/list/index.html", LISTING)], "page_id long, url string, html string")
    out = H.link_listing(pages, r"calls/(\d+)_(\d+)_(\d+)\.html$", "/detail/$1-$2-$3")
    got = sorted((r["link"], r["title"]) for r in out.collect())
    assert got == [("https://proc.example/detail/12-2031-5", "Survey of grid stability"),
                   ("https://proc.example/detail/12-2031-6", "Reactorstudy"),
                   ("https://proc.example/detail/9-2026-1", "Late title")]


CONTAINER = """<html><body><table class="koubo-list">
<tr><th>Title</th><th>Start</th><th>End</th></tr>
<tr><td><a href="/koubo/a.html"> Call A </a></td><td>2024/04/01</td><td>2024-5-31</td></tr>
<tr><td><a href="b.html">Call B</a></td><td>2024年4月2日</td><td>2024/06/30</td></tr>
<tr><td><a href="https://elsewhere.example/c">Call C</a></td><td></td></tr>
</table></body></html>"""


def rows(spark, html, selectors=K.CONTAINER_SELECTORS):
    pages = spark.createDataFrame([(1, "https://www.agency.example/koubo/index.html", html)], "page_id long, url string, html string")
    ev = H.container_rows(pages, selectors).filter(F.col("kind").isNotNull()).filter(H.fallback_anchor_filter())
    link = U.resolve(F.col("href"), F.col("url"))
    dates = D.row_dates(F.col("row_text"))
    return ev.select("kind", link.alias("link"), "title", U.host(link).alias("h"),
                     D.row_date_value(F.get(dates, 0)).alias("p"), D.row_date_value(F.get(dates, 1)).alias("d")) \
             .orderBy("pos").collect()


def test_container_rows(spark):
    r = rows(spark, CONTAINER)
    assert [x["title"] for x in r] == ["Call A", "Call B", "Call C"]       # header row skipped
    assert r[0]["link"] == "https://www.agency.example/koubo/a.html"
    assert r[1]["link"] == "https://www.agency.example/koubo/b.html"     # relative href resolved
    assert str(r[0]["p"]) == "2024-04-01" and str(r[0]["d"]) == "2024-05-31"
    assert r[1]["p"] is None and str(r[1]["d"]) == "2024-06-30"           # 年/月 form uses a slot, gives NULL
    assert r[2]["h"] == "elsewhere.example"                              # the host rule drops it


def test_container_fallback_anchors(spark):
    r = rows(spark, '<p><a href="/koubo/x.html">X</a><a href="/news/y.html">Y</a></p>')
    # no listing rows: every anchor is a candidate, but only hrefs with a listing part pass
    assert [(x["kind"], x["title"]) for x in r] == [("anchor", "X")]


DETAIL = """<html><body><dl>
<dt>公告日</dt><dd><b>令和７年３月１１日</b>(金)</dd>
<dt>質問書提出期限</dt><dd>令和７年３月２１日</dd>
<dt> 期限 </dt><dd><font>令和７年４月２日</font></dd>
<dt>公告日</dt><dd>令和９年１月１日</dd>
<dt>期限</dt><dd>令和７年４月９日</dd>
<dt>期限<br></dt><dd>令和８年９月９日</dd>
</dl></body></html>"""


def test_definition_fields(spark):
    pages = spark.createDataFrame([(1, DETAIL), (2, "<html><body><p>none</p></body></html>")], "id long, html string")
    f = H.definition_fields(H.definition_pairs(pages, keep=("id",)), "id")
    got = {r["id"]: r for r in f.select("id", "ok", D.era_date("first_value").alias("p"),
                                        D.era_date("last_value").alias("d")).collect()}
    assert str(got[1]["p"]) == "2025-03-11" and str(got[1]["d"]) == "2025-04-09"
    assert got[2]["p"] is None and got[2]["d"] is None and got[2]["ok"]


def test_era_dates(spark):
    df = spark.createDataFrame([("令和７年３月１１日",), ("平成7年1月2日",), ("昭和64年1月7日",), ("令和8年2月30日",),
                                ("令和元年5月1日",), ("no date",)], "t string")
    got = [None if r[0] is None else str(r[0]) for r in df.select(D.era_date("t")).collect()]
    assert got == ["2025-03-11", "1995-01-02", "1989-01-07", None, None, None]


def test_lenient_and_feed_dates(spark):
    df = spark.createDataFrame([("2024-05-31T15:00:00.000Z",), ("2024/6/1",), ("20240602",), ("",), ("soon",), (None,)], "s string")
    got = [None if r[0] is None else str(r[0]) for r in df.select(D.lenient_date("s")).collect()]
    assert got == ["2024-05-31", "2024-06-01", "2024-06-02", None, None, None]
    f = spark.createDataFrame([("Tue, 03 Jun 2003 08:00:00 +0900", None), (None, "2024-07-17T10:00:00+09:00"),
                               ("garbage", "2024-01-01")], "p string, u string")
    got = [str(r[0]) for r in f.select(D.feed_date("p", "u")).collect()]
    assert got == ["2003-06-02", "2024-07-17", "2024-01-01"]


RSS = """<rss version="2.0"><channel><title>News</title>
<item><title>Grid call &amp; notes</title><link>https://www.min.example/a</link><description>Desc</description>
<pubDate>Mon, 01 Jul 2024 08:30:00 +0900</pubDate><guid>urn:a</guid></item>
<item><title>Other host</title><link>https://evil.example/b</link></item>
<item><title>Plain http</title><link>http://www.min.example/c</link></item>
<item><title></title><link>https://www.min.example/d</link></item>
<item><title>No link</title></item>
<item><title>Port</title><link>https://www.min.example:8443/e</link></item>
</channel></rss>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel rdf:about="https://www.min.example/"><title>Feed</title><items><rdf:Seq><rdf:li rdf:resource="https://www.min.example/r1"/></rdf:Seq></items></channel>
<item rdf:about="https://www.min.example/r1"><title>RDF item</title><link>https://www.min.example/r1</link><dc:date>2024-07-17T10:00:00+09:00</dc:date></item>
</rdf:RDF>"""


def test_feed_items(spark):
    df = spark.createDataFrame([(1, RSS), (2, RDF), (3, "<rss><channel><item>broken")], "id long, xml string")
    out = FD.feed_items(FD.feed_entries(df, "xml"), ["www.min.example"], "mext").orderBy("id", "pos").collect()
    assert [(r["title"], r["external_id"]) for r in out] == [("Grid call & notes", "urn:a"),
                                                             ("RDF item", "https://www.min.example/r1")]
    assert str(out[0]["posted_date"]) == "2024-06-30"   # 08:30 +0900 is the previous day in UTC


def test_json_items(spark):
    item = {"id": "a1", "title": "Grant A", "acceptance_start_datetime": "2024-05-31T15:00:00.000Z",
            "acceptance_end_datetime": "2024-06-30T15:00:00.000Z"}
    bodies = [
        json.dumps({"metadata": {"type": "x"}, "result": [item, {"id": "", "title": "no id"}, {"id": "b", "title": " "}]}),
        json.dumps({"result": [], "data": [dict(item, id=7)]}),
        json.dumps([dict(item, id=0), dict(item, id="z")]),
        "not json",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    out = FD.json_items(FD.json_entries(df, "body"), "https://portal.example/subsidy/", ["portal.example"], "jgrants")
    got = sorted((r["external_id"], r["url"], str(r["posted_date"]), str(r["deadline"])) for r in out.collect())
    assert got == [("7", "https://portal.example/subsidy/7", "2024-05-31", "2024-06-30"),
                   ("a1", "https://portal.example/subsidy/a1", "2024-05-31", "2024-06-30"),
                   ("z", "https://portal.example/subsidy/z", "2024-05-31", "2024-06-30")]


def test_url_functions(spark):
    df = spark.createDataFrame([("https://www.min.example/a",), ("HTTPS://WWW.MIN.EXAMPLE/a",), ("http://www.min.example/a",),
                                ("https://www.min.example:443/a",), ("https://www.min.example/a b",), ("https://u@www.min.example/",)],
                               "u string")
    got = [r[0] for r in df.select(U.allowed("u", ["www.min.example"])).collect()]
    assert got == [True, True, False, False, False, True]
    r = spark.createDataFrame([("https://h.example/x/y?q=1", h) for h in
                               ["z", "/z", "//o.example/z", "?p=2", "#f", "../z", "./z", "https://a.example/", "",
                                ".", "..", "../../../../z", "/a/./b/../c", "a/b/..", "a/./b/.", "../z?k=1#f",
                                "/../x", "z/", "./", "..z", "z..", "/a/b/../../../c"]],
                              "b string, h string")
    from urllib.parse import urljoin
    for row in r.select("b", "h", U.resolve("h", "b").alias("r")).collect():
        assert row["r"] == (urljoin(row["b"], row["h"]) if row["h"] else None), row
    e = spark.createDataFrame([("https://h.example/12-2031-5/",), ("https://h.example/",)], "u string")
    assert [r[0] for r in e.select(U.last_path_segment("u")).collect()] == ["12-2031-5", "h.example"]


# ---- forms of anchors, deep pages, copies of a page

def test_anchor_forms(spark):
    html = """<a data-href="/no.html" href="/a.html">A &yen;&#12354;</a><a class=x href='/b.html?x=1&amp;y=2'>B</a>
<A HREF=/c.html>C</A><a name="n">none</a><area href="/d.html"><a
 href = "/e.html" title="t">E &lt;b&gt;</a>"""
    pages = spark.createDataFrame([(1, "https://x.example/", html)], "page_id long, url string, html string")
    got = [(r["href"], r["title"]) for r in H.anchors(pages).orderBy("pos").collect()]
    assert got == [("/a.html", "A ¥あ"), ("/b.html?x=1&y=2", "B"), ("/c.html", "C"), ("/e.html", "E <b>")]


def test_deep_page(spark):
    html = "<div>" * 3000 + "<dl><dt>公告日</dt><dd>令和2年1月2日</dd></dl>" + "</div>" * 3000
    pages = spark.createDataFrame([(1, html)], "id long, html string")
    r = H.definition_fields(H.definition_pairs(pages, keep=("id",)), "id").first()
    assert r["ok"] and r["first_value"] == "令和2年1月2日"


def definition_pairs_of_tree(doc):
    """The pairs of a whole tree, as the rule is said."""
    def string(node):
        while isinstance(node, H._Node):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node

    out = []
    for n in H._walk(H.parse_tree(doc)):
        s = string(n) if n.tag == "dt" else None
        if s is None:
            continue
        after = n.parent.children[next(i for i, c in enumerate(n.parent.children) if c is n) + 1:]
        dds = [c for c in after if isinstance(c, H._Node) and c.tag == "dd"]
        out.append((len(out), s, H.text_of(dds[0], " ", True) if dds else None))
    return out


def test_definition_pairs_as_the_tags_go_by():
    rnd = random.Random(11)
    often = ["<dt>", "</dt>", "<dd>", "</dd>", "a", " b ", "<dt>k</dt>", "<dd>v"]
    bits = often * 4 + ["<dl>", "</dl>", "<div>", "</div>", "<b>", "</b>", "<br>", "<br/>", "<dd/>", "<dt/>", "&amp;", "<!-- c -->", "  ",
                        "<p>", "<script>", "</script>", "</zz>", "<img src=x>", "<dt", ">", "<"]
    pairs = 0
    for _ in range(20000):
        doc = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25)))
        expected = definition_pairs_of_tree(doc)
        assert H.definition_events(doc) == expected, doc
        pairs += sum(dd is not None for _, _, dd in expected)
    assert pairs > 1000 and H.definition_events("") == H.definition_events(None) == []


def test_definition_pairs_of_a_long_page():
    """Neither many pairs nor deep ones are trouble."""
    n = 20000
    got = H.definition_events("<dl>" + "".join(f"<dt>k{i}</dt><dd>v{i}</dd>" for i in range(n)) + "</dl>")
    assert len(got) == n and got[-1] == (n - 1, f"k{n - 1}", f"v{n - 1}")
    deep = H.definition_events("<dl>" + "<dt>k</dt><div>" * 3000 + "<dd>v")
    assert len(deep) == 3000 and {dd for _, _, dd in deep} == {None}


def test_copies_of_a_page_are_not_mixed(spark):
    def page(a, b):
        return f"<dl><dt>公告日</dt><dd>{a}</dd><dt>期限</dt><dd>{b}</dd></dl>"
    pages = spark.createDataFrame([(2, "u", page("A2", "B2")), (1, "u", page("A1", "B1")), (3, "v", "<p>no</p>")], "page_id long, url string, html string")
    f = H.first_good_page(H.definition_fields(H.definition_pairs(pages, keep=("url", "page_id")), ["url", "page_id"]))
    assert sorted((r["url"], r["first_value"], r["last_value"]) for r in f.collect()) == [("u", "A1", "B1"), ("v", None, None)]


# ---- feeds that are malformed, Atom, and status rows

def test_malformed_and_atom_feeds(spark):
    rss = ("<rss><channel><item><title>A & B</title><link>https://h.example/1</link></item>"
           "<item><title>broken</titel><link>https://h.example/2</link></item>"
           "<item><title>C</title><link>https://h.example/3</link></item></channel></rss>")
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title type="text">D</title>'
            '<link rel="self" href="https://h.example/self"/><link rel="alternate" href="https://h.example/4"/>'
            "<id>urn:4</id><published>2024-07-01T10:00:00Z</published><summary>S</summary></entry></feed>")
    df = spark.createDataFrame([(1, rss), (2, atom), (3, "no feed"), (4, None)], "id long, xml string")
    out = FD.feed_items(FD.feed_entries(df), ["h.example"], "mext").orderBy("id", "pos").collect()
    assert [(r["id"], r["title"], r["url"]) for r in out] == [(1, "A & B", "https://h.example/1"), (1, "C", "https://h.example/3"), (2, "D", "https://h.example/4")]
    assert out[2]["external_id"] == "urn:4" and str(out[2]["posted_date"]) == "2024-07-01" and out[2]["description"] == "S"
    status = {r["id"]: (r["n_items"], r["error"]) for r in FD.feed_status(df).collect()}
    assert status == {1: (3, None), 2: (1, None), 3: (0, "not a feed"), 4: (0, "empty document")}
    bodies = spark.createDataFrame([(1, "{}"), (2, "{bad")], "id long, body string")
    assert [r["error"] for r in FD.json_status(bodies).orderBy("id").collect()] == [None, "not JSON"]


def test_lenient_dates_equal_dateutil(spark):
    """Every full date form, with and without a time, as dateutil reads it."""
    import datetime

    from dateutil import parser
    forms = []
    for i in range(400):
        d = datetime.date(1990, 1, 1) + datetime.timedelta(days=i * 37)
        y, m, day, name, wd = d.year, d.month, d.day, d.strftime("%B"), d.strftime("%A")
        nth = {1: "st", 2: "nd", 3: "rd"}.get(0 if day in (11, 12, 13) else day % 10, "th")
        every = [f"{y}-{m}-{day}", f"{y}/{m:02d}/{day:02d}", f"{y}.{m:02d}.{day:02d}", f"{y}{m:02d}{day:02d}", f"{y}{m:02d}{day:02d}150000", f"{name} {day}, {y}",
                 f"{name[:3]}. {day} {y}", f"{day} {name} {y}", f"{day}-{name[:3]}-{y}", f"{y} {name[:3]} {day}", f"{y}-{name[:3]}-{day:02d}", f"{day}{nth} of {name} {y}",
                 f"{wd}, {day} {name} {y}", f"{wd[:3]} {name[:3]} {day} {y}", f"{m}/{day}/{y}", f"{m:02d}-{day:02d}-{y}", f"{day}/{name[:3]}/{y}", f"{y}-{m:02d}-31", f"{y}-13-{day}"]
        form = every[i % len(every)]
        forms.append(form if form.isdigit() else form + ("", " 10:30", " 10:30:00 +0900")[i % 3])

    def known(x):
        try:
            return parser.parse(x).date()
        except ValueError:
            return None
    df = spark.createDataFrame(list(enumerate(forms)), "i long, x string")
    assert [r["d"] for r in df.orderBy("i").select(D.lenient_date("x").alias("d")).collect()] == [known(x) for x in forms]


def test_lenient_date_is_matched_once(spark):
    plan = spark.range(1).select(F.col("id").cast("string").alias("x")).select(D.lenient_date("x").alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") + plan.count("regexp_extract(") + plan.count("RLIKE") == 1


def test_more_date_forms(spark):
    given = ["2024.04.01", "April 1, 2024", "2024/04/01T10:00", "20240401T150000Z", "Mon, 01 Apr 2024 10:00:00 +0900", "04/01/2024",
             "1 Apr 2024", "13/04/2024", "２０２４/４/１", "15", "2024-13-01", "Foo 1, 2024", "2024-04", "Apr 2024"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i long, x string")
    got = [str(r[0]) for r in df.orderBy("i").select(D.lenient_date("x")).collect()]
    assert got == ["2024-04-01"] * 7 + ["2024-04-13", "2024-04-01"] + ["None"] * 5
    row = spark.createDataFrame([("開始 ２０２４/０４/０１ から",)], "t string").select(D.row_date_value(F.get(D.row_dates("t"), 0))).first()[0]
    assert str(row) == "2024-04-01"


def feed_rows(spark, *docs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(docs)], "id long, xml string")
    out = FD.feed_items(FD.feed_entries(df), ["h.example"], "mext").orderBy("id", "pos").collect()
    return [(r["id"], r["title"], r["url"], r["description"]) for r in out], {r["id"]: (r["n_items"], r["error"]) for r in FD.feed_status(df).collect()}


def test_feed_cdata_is_text(spark):
    """Nothing within CDATA is markup, a reference or the end of an item."""
    rss = ("<rss><channel><item><title><![CDATA[R&D call & more]]></title><link><![CDATA[https://h.example/2?x=1&y=2]]></link>"
           "<description><![CDATA[a </item> <b>bold</b> &amp; <!-- kept -->]]></description></item>"
           "<item><title>T<![CDATA[]]></title><link>https://h.example/3</link></item></channel></rss>")
    rows, status = feed_rows(spark, rss)
    assert rows == [(0, "R&D call & more", "https://h.example/2?x=1&y=2", "a </item> <b>bold</b> &amp; <!-- kept -->"), (0, "T", "https://h.example/3", None)]
    assert status == {0: (2, None)}


def test_feed_comments_hold_no_items(spark):
    rows, status = feed_rows(spark, "<rss><channel><!-- <item><title>old</title><link>https://h.example/0</link></item> --><item><title>new<!-- x --></title>"
                             "<link>https://h.example/1</link></item></channel></rss>", "<rss><channel><!-- <![CDATA[ --><item><title>A</title><link>https://h.example/2</link></item></channel></rss>")
    assert [r[1] for r in rows] == ["new", "A"] and status == {0: (1, None), 1: (1, None)}


def test_feed_named_references(spark):
    rows, _ = feed_rows(spark, "<rss><channel><item><title>caf&eacute;&nbsp;&amp; bar &copy; &unknown; &#65;&#x42; &lt;i&gt; A & B</title><link>https://h.example/1?a=1&amp;b=2&c=3</link></item></channel></rss>")
    assert rows == [(0, "café & bar © &unknown; AB <i> A & B", "https://h.example/1?a=1&b=2&c=3", None)]


def test_feed_prefixed_elements(spark):
    atom = ('<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:title>F</a:title><a:entry><a:title>T</a:title><a:link href="https://h.example/1"/>'
            "<a:id>urn:1</a:id><a:summary>S</a:summary></a:entry></a:feed>")
    rdf = "<r:RDF xmlns:r='http://www.w3.org/1999/02/22-rdf-syntax-ns#' xmlns:s.1='http://purl.org/rss/1.0/'><s.1:item><s.1:title>U</s.1:title><s.1:link>https://h.example/2</s.1:link></s.1:item></r:RDF>"
    other = "<x:feed xmlns:x='urn:other'><x:entry><x:title>no feed of ours</x:title></x:entry></x:feed>"
    mixed = ('<rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><atom:link href="https://h.example/self" rel="self"/><item><title>V</title>'
             "<link>https://h.example/3</link></item></channel></rss>")
    rows, status = feed_rows(spark, atom, rdf, other, mixed)
    assert [r[:3] for r in rows] == [(0, "T", "https://h.example/1"), (1, "U", "https://h.example/2"), (3, "V", "https://h.example/3")]
    assert rows[0][3] == "S" and status[2] == (0, "not a feed") and status[0] == (1, None)


def test_feed_with_a_long_body_of_markup(spark):
    long_ = "<p>x & y</p>" * 60_000
    rows, _ = feed_rows(spark, f"<rss><channel><item><title>L</title><link>https://h.example/1</link><description><![CDATA[{long_}]]></description></item></channel></rss>")
    assert rows[0][3] == long_


def test_left_out_items_are_judged_once(spark):
    """Title and link of an item are stripped once for the filter and once for
    the rows that stay, however many rules read them."""
    from gazette.sources import feeds as FD
    bodies = [(1, '{"result": [{"id": "a", "title": "T"}, {"id": "", "title": "x"}, {"id": 0, "title": "x"}, {"id": [], "title": "x"}, {"id": "b c", "title": "x"}, {"id": "b", "title": " "}, {"title": false, "id": true}, 5]}'), (2, None)]
    items = FD.json_entries(spark.createDataFrame(bodies, "id long, body string"))
    got = FD.json_item_errors(items, "https://g.example/", ["g.example"])
    assert [(r["pos"], r["error"]) for r in got.orderBy("pos").collect()] == [(1, "id"), (2, "id"), (3, "id"), (4, "url not allowed"), (5, "title"), (6, "title"), (7, "id")]
    entries = spark.createDataFrame([(1, i, i != 3, t, u) for i, (t, u) in enumerate([("T", "https://f.example/1"), (" ", "https://f.example/1"), ("T", None), (None, None), ("T", "http://f.example/1")])],
                                    "id long, pos int, read boolean, title string, link string")
    got = FD.feed_item_errors(entries, ["f.example"])
    assert [(r["pos"], r["error"]) for r in got.orderBy("pos").collect()] == [(1, "title"), (2, "url"), (3, "malformed item"), (4, "url not allowed")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 6
    assert FD.json_item_errors(items, "https://g.example/", ["g.example"])._jdf.queryExecution().optimizedPlan().toString().count("schema_of_variant") <= 20


def test_pairs_of_other_labels_are_not_grouped(spark):
    pairs = spark.createDataFrame([(1, True, None, None, None), (1, True, 0, " 公告日 ", "a"), (1, True, 1, "x", "b"), (1, True, 2, "期限", "c"), (2, True, None, None, None), (2, True, 0, "x", "d"), (3, False, None, None, None)],
                                  "id long, ok boolean, pos int, dt string, dd string")
    f = H.definition_fields(pairs, "id")
    assert {tuple(r) for r in f.collect()} == {(1, True, "a", "c"), (2, True, None, None), (3, False, None, None)}
    assert "Filter" in f._jdf.queryExecution().optimizedPlan().toString()
