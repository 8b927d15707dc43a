"""Incremental intake (I1): new crawl files become micro-batches that run
exactly the batch path (validate -> prepare -> fold -> upsert).

The state is the store itself (``first_seen`` is kept for ever), so there is
no watermark and no in-memory state store: each micro-batch reads the buckets of
the latest snapshot that its urls are in and publishes them as the next version.
The version records the stream's batch in the same step, so a batch that is
replayed after a failure is known and skipped. A batch that meets another writer
(a daily run, another stream) is applied again to what that one published; so
neither loses rows, and a new stream may start over a store that has versions.

Records that fail validation are written to ``<store>/_rejects``.
"""

from __future__ import annotations

import datetime as _dt
import json
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import rejects as RJ
from ..operators import store as ST
from ..operators import taxonomy as TXN
from ..schema import INTAKE
from ..session import ensure_checkpoint_dir
from ..sources import intake as IN


def apply_batch(batch: DataFrame, store: DataFrame, tax: TXN.Taxonomy, run_ts: _dt.datetime,
                sources=None) -> DataFrame:
    """One intake batch applied to the store (the batch path, no scoring)."""
    valid, _ = split(batch, sources)
    return apply_valid(valid, store, tax, run_ts)


def split(batch: DataFrame, sources=None) -> tuple:
    return IN.split_valid(batch, sources if sources is not None else IN.K.SOURCES)


def apply_valid(valid: DataFrame, store: DataFrame, tax: TXN.Taxonomy, run_ts: _dt.datetime) -> DataFrame:
    return ST.upsert(store, ST.fold_batch(kept_rows(valid, tax)), run_ts)


def kept_rows(valid: DataFrame, tax: TXN.Taxonomy) -> DataFrame:
    prepared = TXN.prepare(valid, tax)
    return prepared.filter(F.col("stage") == "kept").withColumn("tender_type", F.col("pre_label"))


def publish_valid(spark: SparkSession, root: str, valid: DataFrame, tax: TXN.Taxonomy, run_ts: _dt.datetime,
                  streams: dict | None = None) -> ST.Snapshot:
    """Apply valid records to the latest version and publish the next one."""
    ensure_checkpoint_dir(spark)
    folded = ST.fold_batch(kept_rows(valid, tax)).checkpoint(eager=True)   # batch-sized; read again on a conflict

    def change(base: ST.Snapshot) -> tuple:
        buckets = base.touched(folded)
        part = base.read(buckets)
        return ST.upsert(part, folded, run_ts, ids=ST.batch_ids(part, folded, max_id=base.max_id)), buckets

    return ST.apply_touched(spark, root, change, streams, first=1)


def start_intake_stream(spark: SparkSession, source_dir: str, store_root: str, checkpoint_dir: str,
                        tax: TXN.Taxonomy, run_ts=None, sources=None, files_per_trigger: int | None = None,
                        available_now: bool = True):
    """Start the stream; returns the StreamingQuery.

    ``run_ts`` is a timestamp or a function ``batch_id -> timestamp``."""
    reader = spark.readStream.schema(INTAKE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(source_dir)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        stream = stream_id(spark, checkpoint_dir)
        if ST.latest(spark, store_root).streams.get(stream, -1) >= batch_id:
            return                                    # replayed batch: already applied
        ts = run_ts(batch_id) if callable(run_ts) else (run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
        valid, rejected = split(df, sources)
        RJ.of_validation(rejected).write.mode("overwrite").parquet(os.path.join(store_root, "_rejects", f"{stream}-{batch_id}"))
        publish_valid(spark, store_root, valid, tax, ts, {stream: batch_id})

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that Spark gave the stream of this checkpoint folder."""
    return json.loads(ST.read_text(spark, os.path.join(checkpoint_dir, "metadata")))["id"]
