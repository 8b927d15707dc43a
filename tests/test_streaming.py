import datetime as dt
import os

from pyspark.sql import functions as F

from gazette.operators import store as ST
from gazette.plans import bindings as B
from gazette.schema import INTAKE_COLUMNS
from gazette.streaming.intake_stream import apply_batch, start_intake_stream
from tests.conftest import SF001

TS = dt.datetime(1998, 6, 1)


def _content(df):
    cols = ["id", "url", "source", "external_id", "title", "tender_type", "keyword_hits", "posted_date", "deadline"]
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_equals_batch(spark, tmpdir_path):
    n = B.documents_intake(spark, SF001).select(*INTAKE_COLUMNS)
    half = B.split_point(spark, SF001)
    src = os.path.join(tmpdir_path, "incoming")
    store_root = os.path.join(tmpdir_path, "store")
    for k, part in enumerate((n.filter(F.col("ord") < half), n.filter(F.col("ord") >= half)), start=1):
        part.write.parquet(os.path.join(src, f"drop-{k}"))          # a new crawl drop arrives
        q = start_intake_stream(spark, os.path.join(src, "*"), store_root, os.path.join(tmpdir_path, "ckpt"),
                                B.taxonomy(), run_ts=TS, sources=B.DOC_SOURCE_PATTERN)
        q.awaitTermination(300)
        assert q.exception() is None
    streamed = ST.read_store(spark, store_root)
    at_once = apply_batch(n, ST.empty_store(spark), B.taxonomy(), TS, B.DOC_SOURCE_PATTERN)
    assert ST.snapshot_versions(spark, store_root) == [1, 2]          # one version per micro-batch
    assert _content(streamed) == _content(at_once)


def _stream(spark, src, root, ckpt, wait=300):
    q = start_intake_stream(spark, src, root, ckpt, B.taxonomy(), run_ts=TS, sources=B.DOC_SOURCE_PATTERN)
    q.awaitTermination(wait)
    assert q.exception() is None


def test_new_stream_over_a_store_with_versions(spark, tmpdir_path):
    """A new stream starts at batch 0 over a store that has versions already:
    its rows arrive, and a replayed batch changes nothing."""
    n = B.documents_intake(spark, SF001).select(*INTAKE_COLUMNS).withColumn("source", F.when(F.col("ord") % 50 == 0, "bad").otherwise(F.col("source")))
    src, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "store")
    for v in (0, 1, 2):
        ST.write_store(ST.empty_store(spark), root, v)
    n.write.parquet(os.path.join(src, "drop-1"))
    _stream(spark, os.path.join(src, "*"), root, os.path.join(tmpdir_path, "ckpt"))
    expected = _content(apply_batch(n, ST.empty_store(spark), B.taxonomy(), TS, B.DOC_SOURCE_PATTERN))
    assert ST.snapshot_versions(spark, root) == [0, 1, 2, 3] and _content(ST.read_store(spark, root)) == expected and expected
    rejects = spark.read.parquet(os.path.join(root, "_rejects", "*"))
    assert rejects.count() == n.where("source = 'bad'").count() > 0
    # the commit of the batch is lost: it is replayed and finds its snapshot
    commits = os.path.join(tmpdir_path, "ckpt", "commits")
    for name in os.listdir(commits):
        os.rename(os.path.join(commits, name), os.path.join(tmpdir_path, name + ".away"))
    _stream(spark, os.path.join(src, "*"), root, os.path.join(tmpdir_path, "ckpt"))
    assert ST.snapshot_versions(spark, root) == [0, 1, 2, 3] and _content(ST.read_store(spark, root)) == expected


def test_daily_run_within_a_stream_batch(spark, tmpdir_path, monkeypatch):
    """Another writer publishes after the batch has read the store and before it
    writes: the batch is applied again, and neither loses rows or shares ids."""
    from gazette.streaming import intake_stream as IS
    n = B.documents_intake(spark, SF001).select(*INTAKE_COLUMNS)
    half = B.split_point(spark, SF001)
    mine, other = n.filter(F.col("ord") < half), n.filter(F.col("ord") >= half)
    src, root = os.path.join(tmpdir_path, "incoming"), os.path.join(tmpdir_path, "store")
    mine.write.parquet(os.path.join(src, "drop-1"))
    real, met = ST.Snapshot.publish, []

    def late(self, new, buckets, streams=None, first=0):
        if streams and not met:
            met.append(self.version)
            IS.publish_valid(spark, root, IS.split(other, B.DOC_SOURCE_PATTERN)[0], B.taxonomy(), TS)
        return real(self, new, buckets, streams, first)

    monkeypatch.setattr(ST.Snapshot, "publish", late)
    _stream(spark, os.path.join(src, "*"), root, os.path.join(tmpdir_path, "ckpt"))
    assert met == [None] and ST.snapshot_versions(spark, root) == [1, 2]
    first = apply_batch(other, ST.empty_store(spark), B.taxonomy(), TS, B.DOC_SOURCE_PATTERN)
    assert _content(ST.read_store(spark, root)) == _content(apply_batch(mine, first, B.taxonomy(), TS, B.DOC_SOURCE_PATTERN))
    assert list(ST.latest(spark, root).streams.values()) == [0]
