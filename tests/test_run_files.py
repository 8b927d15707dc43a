import datetime as dt
import os

from pyspark.sql import functions as F

from gazette.operators import scoring as SC
from gazette.operators import store as ST
from gazette.operators import taxonomy as tx
from gazette.plans.daily import intake_from_files, run_and_publish

LISTING = """<html><body><ul>
<li><a href="calls/1_2026_1.html">Grid reactor survey</a></li>
<li><a href="calls/1_2026_2.html">Battery storage grant</a></li>
</ul></body></html>"""
DETAIL = """<html><body><dl><dt>公告日</dt><dd>令和８年７月１日</dd><dt>期限</dt><dd>令和８年８月１日</dd></dl></body></html>"""
FEED = """<rss version="2.0"><channel><item><title>Reactor notice</title><link>https://www.min.example/n1</link>
<pubDate>Mon, 01 Jul 2026 10:00:00 +0900</pubDate><guid>n1</guid></item></channel></rss>"""
API = """{"result": [{"id": "g1", "title": "Grid grant", "acceptance_start_datetime": "2026-07-01T00:00:00Z",
"acceptance_end_datetime": "2026-09-30T15:00:00.000Z"}]}"""


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_run_from_files(spark, tmpdir_path):
    root = tmpdir_path
    write(f"{root}/listing/index.html", LISTING)
    for name in ("1-2026-1", "1-2026-2"):
        write(f"{root}/detail/{name}", DETAIL)
    write(f"{root}/feeds/f1.xml", FEED)
    write(f"{root}/api/b1.json", API)

    def url_of(path):   # crawl layout: <root>/<kind>/<last segment>
        seg = F.element_at(F.split(path, "/"), -1)
        return F.when(path.contains("/detail/"), F.concat(F.lit("https://proc.example/detail/"), seg)) \
                .otherwise(F.lit("https://proc.example/list/index.html"))

    intake, fails = intake_from_files(
        spark, listing_pages=f"{root}/listing/*", listing_href_pattern=r"calls/(\d+)_(\d+)_(\d+)\.html$",
        listing_url_template="/detail/$1-$2-$3", detail_pages=f"{root}/detail/*",
        feeds=f"{root}/feeds/*", feed_hosts=["www.min.example"],
        api_bodies=f"{root}/api/*", api_url_prefix="https://portal.example/subsidy/", api_hosts=["portal.example"],
        url_of=url_of)
    rows = {r["url"]: r for r in intake.collect()}
    assert fails.count() == 0 and len(rows) == 4
    assert str(rows["https://proc.example/detail/1-2026-1"]["deadline"]) == "2026-08-01"
    assert rows["https://proc.example/detail/1-2026-1"]["external_id"] == "1-2026-1"

    tax = tx.Taxonomy.from_dict({"grid": {"g": ["grid"]}, "nuclear": {"r": ["reactor"]},
                                 "storage": {"b": ["battery"]},
                                 "tender_type_hints": {"subsidy": ["grant"], "commissioned": ["survey"]}})
    out = run_and_publish(spark, intake, tax, f"{root}/store", f"{root}/site", dt.datetime(2026, 7, 2),
                          dt.date(2026, 7, 2), ["grid", "nuclear", "storage"],
                          {"grid": "Grid", "nuclear": "Nuclear", "storage": "Storage"},
                          scorer_factory=SC.rule_scorer_factory)
    assert out["version"] == 0 and out["stats"]["upserted"] == 4 and out["stats"]["fetched"] == 4
    store = ST.read_store(spark, os.path.dirname(out["snapshot"]))
    assert store.count() == 4
    assert dict(store.select("url", "tender_type").collect())["https://portal.example/subsidy/g1"] in ("subsidy", "commissioned", "unknown")
    again = run_and_publish(spark, intake, tax, f"{root}/store", f"{root}/site2", dt.datetime(2026, 7, 3),
                            dt.date(2026, 7, 3), ["grid"], {"grid": "Grid"})
    assert again["version"] == 1 and ST.read_store(spark, os.path.dirname(again["snapshot"]), 1).count() == 4


def test_what_sources_leave_out_is_rejected_and_counted(spark, tmpdir_path):
    root = tmpdir_path
    write(f"{root}/listing/index.html", LISTING)
    write(f"{root}/listing/empty one.html", "")
    write(f"{root}/detail/1-2026-1", DETAIL)                       # that of 1-2026-2 is not there
    bad_item = "<item><title>broken</titel><link>https://www.min.example/n2</link></item>"
    blank = "<item><title> </title><link>https://www.min.example/n3</link></item>"
    away = "<item><title>Away</title><link>https://other.example/n4</link></item>"
    write(f"{root}/feeds/f1.xml", FEED.replace("</channel>", bad_item + blank + away + "</channel>"))
    write(f"{root}/feeds/f2.xml", "")
    write(f"{root}/feeds/f3.xml", "busy, come back later")
    write(f"{root}/feeds/f4.xml", "<rss><channel><item><title>cut")
    write(f"{root}/api/b1.json", API.replace('"result": [', '"result": [{"id": "", "title": "No id"}, {"id": "g2", "title": " "}, '))
    write(f"{root}/api/b2.json", '{"result": [')
    write(f"{root}/api/b3.json", '{"result": {"id": "g3"}}')
    write(f"{root}/rows/p.html", '<table class="x"><tr><td><a href="/e1.html">Grid row</a></td></tr>'
                                 '<tr><td><a href="https://else.example/e2.html">Else</a></td></tr></table>')

    def url_of(path):
        seg = F.element_at(F.split(path, "/"), -1)
        return F.when(path.contains("/detail/"), F.concat(F.lit("https://proc.example/detail/"), seg)) \
                .otherwise(F.lit("https://proc.example/list/index.html"))

    found = intake_from_files(
        spark, listing_pages=f"{root}/listing/*", listing_href_pattern=r"calls/(\d+)_(\d+)_(\d+)\.html$",
        listing_url_template="/detail/$1-$2-$3", detail_pages=f"{root}/detail/*",
        feeds=f"{root}/feeds/*", feed_hosts=["www.min.example"], container_pages=f"{root}/rows/*", container_selectors="table.x tr",
        api_bodies=f"{root}/api/*", api_url_prefix="https://portal.example/subsidy/", api_hosts=["portal.example"],
        url_of=url_of, sequence=lambda p: F.element_at(F.split(p, "/"), -1))
    assert found.failures.count() == 0 and found.intake.count() == 4
    expected = sorted([
        ("jst", "empty%20one.html", "document", "empty document"), ("jst", "https://proc.example/detail/1-2026-2", "detail", "detail page missing"),
        ("mext", "f1.xml#1", "item", "malformed item"), ("mext", "f1.xml#2", "item", "title"), ("mext", "f1.xml#3", "item", "url not allowed"),
        ("mext", "f2.xml", "document", "empty document"), ("mext", "f3.xml", "document", "not a feed"), ("mext", "f4.xml", "document", "item without end"),
        ("nedo", "p.html#1", "item", "url not allowed"),
        ("jgrants", "b1.json#0", "item", "id"), ("jgrants", "b1.json#1", "item", "title"),
        ("jgrants", "b2.json", "document", "not JSON"), ("jgrants", "b3.json", "document", "no list of items")])
    assert sorted(map(tuple, found.rejected.collect())) == expected
    tax = tx.Taxonomy.from_dict({"grid": {"g": ["grid"]}, "tender_type_hints": {"subsidy": ["grant"], "commissioned": ["survey"]}})
    args = (found, tax, f"{root}/store", f"{root}/site", dt.datetime(2026, 7, 2), dt.date(2026, 7, 2), ["grid"], {"grid": "Grid"})
    out = run_and_publish(spark, *args)
    s = out["stats"]
    assert sorted(map(tuple, spark.read.parquet(out["rejects"]).collect())) == expected
    assert s["failed"] == len(expected) and s["exit_status"] == 1
    assert s["fetched"] == 4 + len(expected) == s["excluded"] + s["no_category"] + s["upserted"] + s["failed"]
    capped = run_and_publish(spark, *args, cap=4)["stats"]
    assert capped["truncated_to"] is None and capped["failed"] == len(expected) and capped["fetched"] == s["fetched"]


def test_bad_detail_pages_are_named(spark):
    from gazette.operators import rejects as RJ
    from gazette.sources import html as H
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    fields = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 3, False), ("b", 4, False)], "url string, page_id long, ok boolean")
    out = RJ.of_details(listing, H.first_good_page(fields), H.bad_pages(fields), "jst")
    assert sorted(map(tuple, out.collect())) == [("jst", "b", "detail", "page could not be parsed"), ("jst", "c", "detail", "detail page missing")]


def test_a_source_that_fails_while_it_is_read(spark, tmpdir_path):
    """One unreadable file costs its source; the others are published."""
    root = tmpdir_path
    write(f"{root}/feeds/f.xml", "<rss><channel><item><title>Grid</title><link>https://www.min.example/1</link></item></channel></rss>")
    write(f"{root}/rows/p.html", '<table class="x"><tr><td><a href="/e1.html">Grid row</a></td></tr></table>')
    write(f"{root}/api/b.json.gz", "no gzip")
    found = intake_from_files(
        spark, feeds=f"{root}/feeds/*", feed_hosts=["www.min.example"], container_pages=f"{root}/rows/*", container_selectors="table.x tr",
        api_bodies=f"{root}/api/*", api_url_prefix="https://portal.example/subsidy/", api_hosts=["portal.example"],
        url_of=lambda p: F.lit("https://proc.example/list/index.html"))
    assert [r["source"] for r in found.failures.collect()] == ["jgrants"]
    assert [(r["source"], r["stage"]) for r in found.rejected.collect()] == [("jgrants", "source")]
    tax = tx.Taxonomy.from_dict({"grid": {"g": ["grid"]}})
    out = run_and_publish(spark, found, tax, f"{root}/store", f"{root}/site", dt.datetime(2026, 7, 2), dt.date(2026, 7, 2), ["grid"], {"grid": "Grid"})
    assert out["stats"]["upserted"] == 2 and out["stats"]["failed"] == 1 and ST.read_store(spark, f"{root}/store").count() == 2


def test_sources_are_parsed_once_and_tables_are_read_as_folders(spark, tmpdir_path):
    """Nothing is parsed any more when the intake and the rejects are read, and
    a table of documents gives what a folder of files gives."""
    root, name = tmpdir_path, lambda p: F.element_at(F.split(p, "/"), -1)
    docs = {"feeds": {"f1.xml": "<rss><channel><item><title>Grid</title><link>https://www.min.example/1</link></item></channel></rss>", "f2.xml": ""},
            "api": {"b1.json": '{"result": [{"id": "g1", "title": "T"}, {"id": "", "title": "x"}]}', "b2.json": "{", "b3.json": ""},
            "rows": {"p.html": '<table class="x"><tr><td><a href="/e1.html">Row</a></td></tr></table>'}}
    for kind, files in docs.items():
        for n, text in files.items():
            write(f"{root}/{kind}/{n}", text)
    table = {k: spark.createDataFrame([(f"file:/x/{n}", t) for n, t in v.items()], "path string, body string") for k, v in docs.items()}
    found = [intake_from_files(spark, feeds=s["feeds"], feed_hosts=["www.min.example"], container_pages=s["rows"], container_selectors="table.x tr",
                               api_bodies=s["api"], api_url_prefix="https://portal.example/subsidy/", api_hosts=["portal.example"],
                               url_of=lambda p: F.lit("https://proc.example/list/index.html"), sequence=name)
             for s in ({k: f"{root}/{k}/*" for k in docs}, table)]
    read = [(sorted(map(str, f.intake.collect())), sorted(map(str, f.rejected.collect()))) for f in found]
    assert read[0] == read[1] and len(read[0][0]) == 3 and len(read[0][1]) == 4
    for df in (found[0].intake, found[0].rejected):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not any(x in plan for x in ("from_xml", "parse_json", "mapInPandas", "MapInPandas", "xmltostructs"))


def test_empty_files_are_named(spark, tmpdir_path):
    from gazette.sources import files as FL
    for n, text in (("a/x.xml", ""), ("a/y.xml", "y"), ("b/z.xml", ""), ("b/z.txt", ""), ("c/_skip.xml", ""), ("c/d/w.xml", "")):
        write(f"{tmpdir_path}/{n}", text)
    for pattern, names in (("a", ["x.xml"]), ("*/*.xml", ["x.xml", "z.xml"]), ("{a,b}/*", ["x.xml", "z.txt", "z.xml"]), ("a/x.xml", ["x.xml"]), ("none/*", []), ("*", ["x.xml", "z.txt", "z.xml"])):
        got = FL.empty_documents(spark, f"{tmpdir_path}/{pattern}").collect()
        assert sorted(r["path"].rsplit("/", 1)[1] for r in got) == names, pattern
        assert all(r["path"].startswith("file:///") for r in got)
