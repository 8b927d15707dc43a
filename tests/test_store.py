import datetime as dt
import os

from pyspark.sql import functions as F

from gazette.operators import store as st
from gazette.schema import INTAKE

TS1 = dt.datetime(2024, 1, 1, 0, 0)
TS2 = dt.datetime(2024, 1, 2, 0, 0)


def batch(spark, rows):
    """rows: (ord, url, title, type[, categories])"""
    full = []
    for r in rows:
        o, url, title, ttype = r[:4]
        full.append((o, "jst", f"e{o}", title, url, None, None, None, ttype))
    df = spark.createDataFrame(full, INTAKE)
    return df.withColumn("categories", F.create_map(F.lit("c"), F.array(F.lit("s"))))


def run(spark, store, rows, ts):
    return st.upsert(store, st.fold_batch(batch(spark, rows)), ts)


def by_url(df):
    return {r["url"]: r for r in df.collect()}


def test_insert_then_update_keeps_first_seen(spark):
    s1 = run(spark, st.empty_store(spark), [(1, "u1", "old", "unknown")], TS1)
    s2 = run(spark, s1, [(2, "u1", "new", "unknown")], TS2)
    r = by_url(s2)["u1"]
    assert s2.count() == 1 and r["title"] == "new"
    assert r["first_seen"] == TS1 and r["last_checked"] == TS2
    assert r["source"] == "jst" and r["external_id"] == "e1"  # not changed on update


def test_same_url_twice_in_one_batch(spark):
    s = run(spark, st.empty_store(spark), [(1, "u1", "first", "unknown"), (2, "u1", "second", "unknown")], TS1)
    r = by_url(s)["u1"]
    assert s.count() == 1 and r["title"] == "second" and r["external_id"] == "e1"


def test_confirmed_type_not_downgraded(spark):
    s1 = run(spark, st.empty_store(spark), [(1, "u1", "t", "commissioned")], TS1)
    s2 = run(spark, s1, [(2, "u1", "t2", "unknown")], TS2)
    r = by_url(s2)["u1"]
    assert r["tender_type"] == "commissioned" and r["title"] == "t2"


def test_unknown_upgraded_to_confirmed(spark):
    s1 = run(spark, st.empty_store(spark), [(1, "u1", "t", "unknown")], TS1)
    s2 = run(spark, s1, [(2, "u1", "t", "subsidy")], TS2)
    assert by_url(s2)["u1"]["tender_type"] == "subsidy"


def test_last_confirmed_wins_within_batch(spark):
    s = run(spark, st.empty_store(spark), [(1, "u", "a", "subsidy"), (2, "u", "b", "commissioned"),
                                          (3, "u", "c", "unknown")], TS1)
    assert by_url(s)["u"]["tender_type"] == "commissioned"


def test_no_category_gives_null_hits(spark):
    df = batch(spark, [(1, "u1", "t", "unknown")]).withColumn(
        "categories", F.from_json(F.lit("{}"), "map<string,array<string>>"))
    s = st.upsert(st.empty_store(spark), st.fold_batch(df), TS1)
    r = s.first()
    assert r["keyword_hits"] is None and r["categories"] == {}


def test_new_ids_continue_sequence_in_first_appearance_order(spark):
    s1 = run(spark, st.empty_store(spark), [(1, "a", "t", "unknown"), (2, "b", "t", "unknown")], TS1)
    assert sorted((r["url"], r["id"]) for r in s1.collect()) == [("a", 1), ("b", 2)]
    s2 = run(spark, s1, [(5, "d", "t", "unknown"), (3, "c", "t", "unknown"), (4, "a", "t", "unknown")], TS2)
    ids = {r["url"]: r["id"] for r in s2.collect()}
    assert ids == {"a": 1, "b": 2, "c": 3, "d": 4}


def _content(df):
    cols = ["id", "url", "source", "external_id", "title", "tender_type", "keyword_hits"]
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_two_halves_equal_batch_at_once(spark):
    rows = [(i, f"u{i % 7}", f"t{i}", ["unknown", "subsidy", "commissioned"][i % 3]) for i in range(40)]
    at_once = run(spark, st.empty_store(spark), rows, TS1)
    halves = run(spark, run(spark, st.empty_store(spark), rows[:20], TS1), rows[20:], TS1)
    assert _content(at_once) == _content(halves)


def test_upsert_idempotent(spark):
    rows = [(i, f"u{i % 5}", f"t{i}", "unknown") for i in range(12)]
    once = run(spark, st.empty_store(spark), rows, TS1)
    twice = run(spark, once, rows, TS1)
    assert _content(once) == _content(twice)


def test_new_vs_known(spark):
    s1 = run(spark, st.empty_store(spark), [(1, "a", "t", "unknown")], TS1)
    b = batch(spark, [(2, "a", "t", "unknown"), (3, "b", "t", "unknown"), (4, "b", "t", "unknown")])
    r = st.new_vs_known(s1, b).first()
    assert (r["batch_records"], r["known_urls"], r["new_urls"]) == (3, 1, 1)


def test_snapshots_and_backfill(spark, tmpdir_path):
    s1 = run(spark, st.empty_store(spark), [(1, "a", "t", "commissioned")], TS1)
    st.write_store(s1.drop("tender_type", "categories"), tmpdir_path, 0)     # written before the column existed
    old = st.read_store(spark, tmpdir_path)
    assert old.first()["tender_type"] == "unknown"
    st.write_store(s1.drop("categories"), tmpdir_path, 1)
    assert st.read_store(spark, tmpdir_path).first()["tender_type"] == "commissioned"
    assert st.snapshot_versions(spark, tmpdir_path) == [0, 1]
    once = st.backfill_columns(s1.drop("tender_type"))
    assert st.backfill_columns(once).columns == once.columns


def _files(root, version):
    return sorted(x for x in os.listdir(os.path.join(root, f"v={version}")) if x.startswith("bucket="))


def test_a_batch_writes_its_buckets_only(spark, tmpdir_path):
    """One url touches one bucket; the others stay where they are, all rows are
    read, old versions stay readable, and ids go on without a scan."""
    def publish(rows, ts):
        folded = st.fold_batch(batch(spark, rows)).cache()

        def change(base):
            buckets = base.touched(folded)
            part = base.read(buckets)
            return st.upsert(part, folded, ts, ids=st.batch_ids(part, folded, max_id=base.max_id)), buckets
        return st.apply_touched(spark, tmpdir_path, change, buckets=8)

    every = [(i, f"u{i}", f"t{i}", "unknown") for i in range(100)]
    publish(every, TS1)
    assert len(_files(tmpdir_path, 0)) == 8
    after = publish([(200, "u7", "changed", "subsidy")], TS2)
    assert after.version == 1 and len(_files(tmpdir_path, 1)) == 1 and sorted(set(after.at)) == [0, 1]
    rows = by_url(st.read_store(spark, tmpdir_path))
    assert len(rows) == 100 and rows["u7"]["title"] == "changed" and rows["u8"]["title"] == "t8" and rows["u7"]["id"] == 8
    assert by_url(st.read_store(spark, tmpdir_path, 0))["u7"]["title"] == "t7"
    assert publish([(300, "new", "n", "unknown")], TS2).max_id == 101
    assert by_url(st.read_store(spark, tmpdir_path))["new"]["id"] == 101
    at_once = run(spark, run(spark, run(spark, st.empty_store(spark), every, TS1), [(200, "u7", "changed", "subsidy")], TS2), [(300, "new", "n", "unknown")], TS2)
    assert _content(st.read_store(spark, tmpdir_path)) == _content(at_once)
    read = st.latest(spark, tmpdir_path).read([after.at.index(1)])._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in read


def test_a_store_without_buckets_gets_them(spark, tmpdir_path):
    s1 = run(spark, st.empty_store(spark), [(i, f"u{i}", "t", "unknown") for i in range(20)], TS1)
    st.write_store(s1.drop("tender_type"), tmpdir_path, 3)
    folded = st.fold_batch(batch(spark, [(50, "u3", "new", "unknown")]))

    def change(base):
        buckets = base.touched(folded)
        part = base.read(buckets)
        return st.upsert(part, folded, TS2, ids=st.batch_ids(part, folded, max_id=base.max_id)), buckets
    done = st.apply_touched(spark, tmpdir_path, change, buckets=4)
    assert done.version == 4 and set(done.at) == {4} and done.max_id == 20
    assert len(by_url(st.read_store(spark, tmpdir_path))) == 20


def test_a_taken_version_is_a_conflict(spark, tmpdir_path):
    import pytest
    s1 = run(spark, st.empty_store(spark), [(1, "a", "t", "unknown")], TS1)
    base = st.latest(spark, tmpdir_path)
    every = list(range(base.buckets))
    base.publish(s1, every)
    with pytest.raises(st.Conflict):
        base.publish(s1, every)
    assert st.snapshot_versions(spark, tmpdir_path) == [0] and st.read_store(spark, tmpdir_path).count() == 1
