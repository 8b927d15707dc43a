"""Physical-plan checks: filters reach the Parquet scan, scans read only the
columns used, hot keys are combined map-side, no single-partition window
over a table, no Python in the dictionary match."""

import datetime as dt

from pyspark.sql import functions as F

from gazette.operators import report as R
from gazette.operators import scoring as SC
from gazette.operators import store as ST
from gazette.operators import taxonomy as tx
from gazette.plans import bindings as B
from gazette.sources import intake as IN
from tests.conftest import SF001


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def _snapshot(spark, root):
    n = B.documents_intake(spark, SF001)
    kept = tx.prepare(n, B.taxonomy()).filter("stage = 'kept'").withColumn("tender_type", F.col("pre_label"))
    ST.write_store(ST.upsert(ST.empty_store(spark), ST.fold_batch(kept), B.RUN_TS), root, 0)
    return ST.read_store(spark, root)


def test_store_filters_pushed_and_columns_pruned(spark, tmpdir_path):
    store = _snapshot(spark, tmpdir_path)
    p = plan(SC.pending(store, None).select("id", "title"))
    assert "PushedFilters: [IsNull(score)]" in p
    assert "ReadSchema: struct<id:bigint,title:string,score:double>" in p
    c = plan(SC.relabel_candidates(store, dt.date(1998, 6, 1)).select("id"))
    assert "Or(IsNull(deadline),GreaterThanOrEqual(deadline,1998-06-01))" in c
    a = plan(store.filter(R.active_filter(dt.date(1998, 6, 1))).select("id"))
    assert "IsNotNull(score)" in a and "GreaterThanOrEqual(score,5.0)" in a
    assert "description" not in a.split("ReadSchema:")[1].split("\n")[0]


def test_fold_combines_map_side(spark):
    n = B.documents_intake(spark, SF001).withColumn("categories", F.create_map())
    p = plan(ST.fold_batch(n))
    assert "partial_min_by" in p and "partial_max_by" in p


def test_keep_first_and_keyword_union_are_partial(spark):
    n = B.documents_intake(spark, SF001)
    p = plan(IN.keyword_union(n, ["ev", "iter"], limit=50))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "partial_min_by" in p


def test_dictionary_match_has_no_join_or_python(spark):
    n = B.documents_intake(spark, SF001)
    p = plan(tx.categorise(n, B.taxonomy(), method="expr"))
    for op in ("Join", "NestedLoop", "Cartesian", "ArrowEvalPython", "MapInPandas"):
        assert op not in p, op


def test_board_has_no_single_partition_window_over_rows(spark, tmpdir_path):
    store = _snapshot(spark, tmpdir_path)
    board = R.active_board(store.withColumn("score", F.lit(7.0)), dt.date(1997, 6, 1), ["grid"], {"grid": "Grid"})
    ranks = sorted(r[0] for r in board.select("board_rank").collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
