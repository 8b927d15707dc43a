import os
import datetime as dt
import json

from pyspark.sql import functions as F

from gazette.operators import scoring as SC


def validate(spark, answers):
    rows = [(i, a if isinstance(a, str) or a is None else json.dumps(a), None) for i, a in enumerate(answers)]
    df = spark.createDataFrame(rows, "id long, raw string, scorer_error string")
    return {r["id"]: r for r in SC.validate_answers(df).collect()}


BASE = {"energy_system_score": 7, "reason": "ok", "is_research": True, "tender_type": "commissioned"}


def variant(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return d


def test_answer_shapes(spark):
    cases = [
        (variant(), True, 7, "commissioned"),
        (variant(energy_system_score=7.0), True, 7, "commissioned"),
        (variant(energy_system_score="7"), True, 7, "commissioned"),
        (variant(energy_system_score="7.0"), True, 7, "commissioned"),
        (variant(energy_system_score=True), True, 1, "commissioned"),
        (variant(energy_system_score=7.5), False, None, None),
        (variant(energy_system_score=99), False, None, None),
        (variant(energy_system_score=-1), False, None, None),
        (variant(reason="r" * 200), True, 7, "commissioned"),
        (variant(reason="r" * 201), False, None, None),
        (variant(reason=5), False, None, None),
        (variant(tender_type=KeyError), True, 7, "unknown"),
        (variant(tender_type="grant"), True, 7, "unknown"),
        (variant(is_research="yes"), True, 7, "commissioned"),
        (variant(is_research=2), False, None, None),
        (variant(extra=[1]), True, 7, "commissioned"),
        ("{not json", False, None, None),
        ("[1, 2]", False, None, None),
    ]
    got = validate(spark, [c[0] for c in cases])
    for i, (_, ok, score, ttype) in enumerate(cases):
        r = got[i]
        assert (r["ok"], r["answer_score"], r["answer_type"]) == (ok, score, ttype), (i, cases[i][0], r)


def test_type_invalid_with_other_defect_fails(spark):
    r = validate(spark, [variant(tender_type="grant", energy_system_score=42)])[0]
    assert not r["ok"] and r["error"] == "score"


def test_scorer_error_counts_as_failed(spark):
    df = spark.createDataFrame([(1, None, "timeout")], "id long, raw string, scorer_error string")
    r = SC.validate_answers(df).first()
    assert not r["ok"] and r["error"] == "scorer"


def store(spark):
    rows = [(1, 3.0, "old", False, "commissioned", dt.date(2030, 1, 1)),
            (2, None, None, None, "unknown", None),
            (3, None, None, None, None, dt.date(2000, 1, 1)),
            (4, None, None, None, "subsidy", dt.date(2030, 1, 1))]
    return spark.createDataFrame(rows, "id long, score double, ai_reason string, is_research boolean, "
                                       "tender_type string, deadline date")


def test_merge_guards(spark):
    answers = spark.createDataFrame(
        [(1, True, 9, "new", True, "unknown"), (2, True, 6, "r", False, "subsidy"),
         (3, False, None, None, None, None), (99, True, 5, "gone", True, "subsidy")],
        "id long, ok boolean, answer_score int, answer_reason string, answer_is_research boolean, answer_type string")
    m = {r["id"]: r for r in SC.merge_scores(store(spark), answers).collect()}
    assert (m[1]["score"], m[1]["ai_reason"], m[1]["tender_type"]) == (9.0, "new", "commissioned")
    assert (m[2]["score"], m[2]["tender_type"]) == (6.0, "subsidy")
    assert m[3]["score"] is None                      # failed answer: unchanged
    assert len(m) == 4                                # answer for a vanished id ignored
    t = {r["id"]: r for r in SC.merge_scores(store(spark), answers, type_only=True).collect()}
    assert t[1]["score"] == 3.0 and t[2]["tender_type"] == "subsidy"


def test_pending_and_candidates(spark):
    s = store(spark)
    assert [r["id"] for r in SC.pending(s, 2).collect()] == [2, 3]
    cand = sorted(r["id"] for r in SC.relabel_candidates(s, dt.date(2024, 1, 1)).collect())
    assert cand == [2]          # 1 confirmed, 3 past deadline, 4 confirmed
    assert SC.relabel_candidates(s, dt.date(2024, 1, 1), limit=0).count() == 0


def test_score_rows_and_outcomes(spark):
    df = spark.createDataFrame([(i, "t" * i, "d" * (i * 3)) for i in range(1, 30)], "id long, title string, description string")
    raw = SC.score_rows(df, SC.rule_scorer_factory)
    assert raw.count() == 29 and set(raw.columns) == {"id", "raw", "scorer_error"}
    answers = SC.validate_answers(raw)
    out = {r["outcome"]: r["n"] for r in SC.relabel_outcomes(answers).collect()}
    assert sum(out.values()) == 29 and out.get("failed", 0) >= 2      # lt=13, 26 fail


def _counting(folder):
    """A scorer that leaves a file for each row it is asked for."""
    def factory():
        rule = SC.rule_scorer_factory()

        def scorer(pdf):
            import uuid
            for k in pdf["_key"]:
                open(os.path.join(folder, f"{k}-{uuid.uuid4().hex}"), "w").close()
            return rule(pdf)
        return scorer
    return factory


def test_a_task_that_is_tried_again_asks_nobody_twice(spark, tmpdir_path, monkeypatch):
    """The job fails after its answers were given; the next attempt, with the
    same ledger, asks only for rows without an answer."""
    import pytest
    monkeypatch.setattr(SC, "ROWS_A_TASK", 40)
    monkeypatch.setattr(SC, "ROWS_A_NOTE", 7)
    calls, ledger = os.path.join(tmpdir_path, "calls"), os.path.join(tmpdir_path, "ledger")
    os.mkdir(calls)
    rows = spark.range(200).select("id", F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"), F.lit("text").alias("description"))
    asked = SC.score_rows(rows, _counting(calls), ledger=ledger)
    assert asked.rdd.getNumPartitions() == 5                      # by rows, not by cores
    broken = asked.select(F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)).alias("x"))
    with pytest.raises(Exception, match="lost"):
        broken.collect()
    got = {r["id"]: (r["raw"], r["scorer_error"]) for r in asked.collect()}
    assert len(os.listdir(calls)) == 200 == len({f.split("-")[0] for f in os.listdir(calls)})
    assert got == {r["id"]: (r["raw"], r["scorer_error"]) for r in SC.score_rows(rows, SC.rule_scorer_factory).collect()}


def test_very_many_rows_get_larger_tasks():
    """One task for 500 rows; of very many rows no task of its own for each 500."""
    assert [SC.tasks_for(n, 12) for n in (0, 1, 500, 501, 48_000)] == [1, 1, 1, 2, 96]
    assert SC.tasks_for(1_000_000, 12) == 96 and SC.tasks_for(11_000_000, 12) == 550


def test_answers_are_validated_once(spark):
    from gazette.plans.daily import scored_once
    rows = spark.range(1, 30).select("id", F.lit("title").alias("title"), F.lit("text").alias("description"))
    answers = scored_once(rows, SC.rule_scorer_factory)
    assert answers.count() == 29
    assert "parse_json" not in answers._jdf.queryExecution().optimizedPlan().toString()
