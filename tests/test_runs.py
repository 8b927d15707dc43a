import datetime as dt

from pyspark.sql import functions as F

from gazette.operators import scoring as SC
from gazette.plans.daily import backlog_run, daily_run, publish_only, relabel, relabel_run, score_backlog


def store(spark):
    rows = [(i, f"title {i}" + "x" * i, "desc " * (i % 7), None if i % 3 else 4.0,
             ["unknown", None, "commissioned"][i % 3], dt.date(2030, 1, 1) if i % 4 else dt.date(2000, 1, 1))
            for i in range(1, 40)]
    return spark.createDataFrame(rows, "id long, title string, description string, score double, "
                                       "tender_type string, deadline date") \
        .withColumn("ai_reason", F.lit(None).cast("string")).withColumn("is_research", F.lit(None).cast("boolean"))


def test_score_backlog_scores_only_pending_up_to_limit(spark):
    s = store(spark)
    out = {r["id"]: r for r in score_backlog(s, SC.rule_scorer_factory, limit=10)[0].collect()}
    before = {r["id"]: r for r in s.collect()}
    pending_ids = sorted(i for i, r in before.items() if r["score"] is None)[:10]
    changed = [i for i in out if out[i]["score"] != before[i]["score"]]
    assert set(changed) <= set(pending_ids)                       # only the first 10 pending rows
    assert all(out[i]["score"] == 4.0 for i in before if before[i]["score"] == 4.0)
    assert changed                                                # some answers were valid


def test_relabel_changes_type_only(spark):
    s = store(spark)
    new, answers = relabel(s, dt.date(2024, 1, 1), SC.rule_scorer_factory)
    counts = {r["outcome"]: r["n"] for r in SC.relabel_outcomes(answers).collect()}
    cand = [r for r in s.collect() if (r["deadline"] is None or r["deadline"] >= dt.date(2024, 1, 1))
            and r["tender_type"] in (None, "unknown")]
    assert sum(counts.values()) == len(cand)
    before = {r["id"]: r for r in s.collect()}
    for r in new.collect():
        b = before[r["id"]]
        assert r["score"] == b["score"] and r["title"] == b["title"]        # only the type may change
        if b["tender_type"] == "commissioned":
            assert r["tender_type"] == "commissioned"                       # confirmed rows untouched


def failing_factory(calls):
    """A scorer that fails a whole batch because of one row; counts calls in a file."""
    def factory():
        inner = SC.rule_scorer_factory()

        def scorer(pdf):
            with open(calls, "a") as f:
                f.write("".join(f"{len(pdf)} {k}\n" for k in pdf["_key"]))
            if (pdf["_key"] == 7).any():
                raise RuntimeError("no answer")
            return inner(pdf)
        return scorer
    return factory


def test_one_failing_row_costs_no_other(spark, tmpdir_path):
    s = store(spark)
    answers = SC.validate_answers(SC.score_rows(s, failing_factory(tmpdir_path + "/calls"), partitions=2)).collect()
    good = SC.validate_answers(SC.score_rows(s, SC.rule_scorer_factory)).collect()
    by = {r["id"]: r for r in answers}
    assert by[7]["error"] == "scorer" and by[7]["scorer_error"] == "RuntimeError: no answer"
    assert {r["id"]: r["ok"] for r in good if r["id"] != 7} == {i: r["ok"] for i, r in by.items() if i != 7}


def counting_factory(path):
    def factory():
        inner = SC.rule_scorer_factory()

        def scorer(pdf):
            with open(path, "a") as f:
                f.write("x\n" * len(pdf))
            return inner(pdf)
        return scorer
    return factory


def full_store(spark):
    from gazette.schema import STORE
    from gazette.operators import store as ST
    s = store(spark)
    for f in STORE.fields:
        if f.name not in s.columns:
            s = s.withColumn(f.name, F.lit(None).cast(f.dataType))
    return s.withColumn("url", F.concat(F.lit("https://x.example/"), "id")).select(*[f.name for f in STORE.fields]), ST


def test_runs_write_publish_and_count(spark, tmpdir_path):
    s, ST = full_store(spark)
    root, site, calls = tmpdir_path + "/store", tmpdir_path + "/site", tmpdir_path + "/n"
    ST.write_store(s, root, 0)
    args = (spark, root, site, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), ["grid"], {"grid": "Grid"})
    n = SC.relabel_candidates(s, dt.date(2024, 1, 1)).count()
    assert relabel_run(*args, counting_factory(calls), dry_run=True)["candidates"] == n and ST.snapshot_versions(spark, root) == [0]
    out = relabel_run(*args, counting_factory(calls))
    assert out["asked"] == n == sum(out["outcomes"].values()) and len(open(calls).readlines()) == n     # one call a candidate
    assert out["version"] == 1 and out["exit_status"] == int(out["failed"] > 0)
    back = backlog_run(*args, SC.rule_scorer_factory, limit=5)
    assert back["asked"] == 5 and back["version"] == 2 and spark.read.parquet(back["archive"]).count() == s.count()
    assert publish_only(*args)["version"] == 2


def test_counters_add_up(spark):
    from gazette.operators import store as ST
    from gazette.plans import bindings as B
    n = B.documents_intake(spark, "/root/testdata/sf0.001").withColumn("url", F.when(F.col("ord") % 9 == 0, "ftp://x").otherwise(F.col("url")))
    res = daily_run(n, B.taxonomy(), ST.empty_store(spark), B.RUN_TS, B.AS_OF, ["grid"], {"grid": "Grid"},
                    SC.rule_scorer_factory, sources=B.DOC_SOURCE_PATTERN)
    r, bad = res.stats.first(), res.rejected.groupBy("stage").count().collect()
    stages = {x["stage"]: x["count"] for x in bad}
    assert r["fetched"] == n.count() == r["excluded"] + r["no_category"] + r["upserted"] + stages["validation"]
    assert r["failed"] == sum(stages.values()) and r["exit_status"] == 1
