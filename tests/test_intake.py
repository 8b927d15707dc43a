import datetime as dt

import pytest
from pyspark.sql import functions as F

from gazette.schema import INTAKE
from gazette.sources import intake as IN


def recs(spark, rows):
    return spark.createDataFrame(rows, INTAKE)


def R(o, source="jst", title="t", url="https://a.example/x", posted=None, ttype="unknown", ext=None, desc=None):
    return (o, source, ext, title, url, desc, posted, None, ttype)


def test_validation_rules(spark):
    df = recs(spark, [R(1), R(2, source="rss"), R(3, url="ftp://x"), R(4, title="　 "), R(5, ttype="grant"),
                      R(6, ttype=None), R(7, title="　Title　")])
    got = {r["ord"]: (r["valid"], list(r["errors"]), r["title"], r["tender_type"]) for r in IN.validate_records(df).collect()}
    assert got[1][0] and got[6][0] and got[6][3] == "unknown"
    assert got[2][1] == ["source"] and got[3][1] == ["url"] and got[4][1] == ["title"] and got[5][1] == ["tender_type"]
    assert got[7][2] == "Title"
    valid, rejected = IN.split_valid(df)
    assert valid.count() == 3 and rejected.count() == 4


def test_cap_before_since(spark):
    rows = [R(i, posted=dt.date(2024, 1, 1) if i % 2 else None) for i in range(10)]
    df = recs(spark, rows)
    capped = IN.cap(df, 3)
    assert [r["ord"] for r in capped.collect()] == [0, 1, 2]
    kept = IN.since_filter(capped, dt.date(2025, 1, 1))
    assert sorted(r["ord"] for r in kept.collect()) == [0, 2]          # NULL posted kept, old dropped
    assert IN.since_filter(df, None).count() == 10 and IN.cap(df, None).count() == 10


def test_keyword_union(spark):
    rows = [R(i, title=f"alpha {i}" + (" beta" if i % 2 else ""), url=f"https://a.example/{i}", ext=str(i))
            for i in range(30)]
    df = recs(spark, rows)
    u = IN.keyword_union(df, ["alpha", "beta"], limit=12).collect()
    # per keyword cap max(10, 12 // 2) = 10 newest; beta's rows already taken by alpha are dropped
    assert [r["ord"] for r in u] == list(range(29, 19, -1)) + [19, 17]
    assert len({r["ord"] for r in u}) == len(u)
    with pytest.raises(ValueError):
        IN.keyword_union(df, ["alpha"], limit=0)
    dated = recs(spark, [R(i, title="alpha", url=f"https://a.example/{i}", ext=str(i),
                           posted=dt.date(2024, 1, 1 + i)) for i in range(5)])
    assert sorted(r["ord"] for r in IN.keyword_union(dated, ["alpha"], since=dt.date(2024, 1, 4)).collect()) == [3, 4]


def test_source_failure_isolated(spark):
    good = lambda: recs(spark, [R(1)])
    bad = lambda: spark.read.parquet("/nonexistent/path/for/test")
    union, fails = IN.union_sources(spark, [("jst", good), ("mext", bad), ("nedo", good)])
    assert union.count() == 2
    assert [tuple(r) for r in fails.collect()] == [("mext", "AnalysisException")]
    assert sorted(r["source_rank"] for r in union.collect()) == [0, 2]
