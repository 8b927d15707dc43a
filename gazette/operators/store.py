"""The keyed store and its upsert.

A batch is folded to one row per url first (E4): the reference applies
upserts one record at a time, so for a url seen k times in one batch the end
state is — source and external_id of the first record (kept for ever once
stored), title / description / dates / categories / hits of the last record,
and the type of the last *confirmed* record. The fold is a single aggregate
with map-side partial ``min_by`` / ``max_by``, so a url repeated a billion
times is reduced in every map task before the shuffle.

The folded batch then meets the store in one full outer equi-join on url (C2).
Known urls update, new urls insert, store-only rows pass through. New ids
continue the store's sequence in first-appearance order.

Stores are Parquet snapshots ``<root>/v=<n>``; a run reads v=n and writes
v=n+1, never overwriting the version it reads. A snapshot is dealt into buckets
by the hash of the url. A run reads only the buckets that its batch touches,
writes them into its version's folder, and takes the others from where they are:
``_layout`` in the folder names, for each bucket, the version that holds it (and
the store's greatest id, so that no scan is needed to continue the ids).

A version is published by renaming its finished folder to ``v=<n+1>``, which
fails if another writer was there first; the run is then applied again to the
version it lost against (``apply_touched``). The batches of streams are
recorded in the same step, so a replayed batch is known. The rename has to be
atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import ts_lit

from .. import constants as K
from ..schema import STORE, STORE_COLUMNS
from ..session import ensure_checkpoint_dir
from .ordering import global_rank
from .taxonomy import CATEGORIES_TYPE, hits_json

_LAST = ["title", "description", "posted_date", "deadline", "categories"]


def empty_store(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STORE)


def fold_batch(batch: DataFrame, type_col: str = "tender_type", confirmed=K.CONFIRMED_TYPES) -> DataFrame:
    """One row per url with the end state of applying the batch in ``ord`` order."""
    cols = set(batch.columns)
    if "categories" not in cols:
        batch = batch.withColumn("categories", F.from_json(F.lit("{}"), CATEGORIES_TYPE))
    first = F.min_by(F.struct("source", "external_id"), "ord")
    last = F.max_by(F.struct(*_LAST), "ord")
    conf_list = ", ".join("'" + c + "'" for c in confirmed)
    last_conf = F.expr(f"max_by(`{type_col}`, ord) FILTER (WHERE `{type_col}` IN ({conf_list}))")
    return (batch.groupBy("url")
            .agg(first.alias("_f"), last.alias("_l"), last_conf.alias("confirmed_type"),
                 F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n_records"))
            .select("url", "_f.source", "_f.external_id", *[F.col("_l." + c).alias(c) for c in _LAST],
                    "confirmed_type", "first_ord", "n_records"))


def batch_ids(store: DataFrame, folded: DataFrame, checkpoint: bool = True, max_id: int | None = None) -> DataFrame:
    """``(url, id)`` for every url of a folded batch: the stored id of a known
    url, else the next id after the store's maximum (``max_id``, if ``store`` is
    a part of it) in order of first appearance. Reads only the store's (url, id)
    columns; the result is batch-sized."""
    max_id = F.lit(max_id).cast("long") if max_id is not None else store.select(F.coalesce(F.max("id"), F.lit(0)).cast("long")).scalar()
    keys = folded.select("url", "first_ord").join(store.select("url", F.col("id").alias("_sid")), "url", "left")
    # the ranking of new urls is checkpointed inside global_rank; the final
    # join is by url, so ``keys`` itself needs no fixed row order
    new = global_rank(keys.filter(F.col("_sid").isNull()), ["first_ord", "url"], out="_rank",
                      checkpoint=checkpoint).select("url", (max_id + F.col("_rank")).alias("_nid"))
    return keys.join(new, "url", "left").select("url", F.coalesce("_sid", "_nid").alias("id"))


def upsert(store: DataFrame, folded: DataFrame, run_ts: _dt.datetime, checkpoint: bool = True,
           ids: DataFrame | None = None) -> DataFrame:
    """Apply a folded batch to the store; returns the new store (STORE schema).

    Ids are settled on the batch side first (:func:`batch_ids`); the store is
    then read once, in a single full outer join, and the result is written
    once by the caller as the next snapshot. When the ids are computed here,
    ``folded`` is read twice (id lookup and join), so with ``checkpoint`` it is
    cut once first (it is batch-sized); callers passing ``ids`` manage that
    themselves (``daily_run`` does)."""
    if ids is None:
        if checkpoint:
            ensure_checkpoint_dir(folded.sparkSession)
            folded = folded.checkpoint(eager=True)
        ids = batch_ids(store, folded, checkpoint)
    batch = folded.join(ids.withColumnRenamed("id", "new_id"), "url", "left")
    ts = ts_lit(run_ts)
    s = store.select(*[F.col(c).alias("s_" + c) for c in STORE_COLUMNS])
    b = batch.select(*[F.col(c).alias("b_" + c) for c in batch.columns])
    j = s.join(b, s["s_url"] == b["b_url"], "full_outer")
    touched = F.col("b_url").isNotNull()
    known = F.col("s_url").isNotNull()

    def upd(c):  # batch value for touched rows (even NULL), stored value otherwise
        return F.when(touched, F.col("b_" + c)).otherwise(F.col("s_" + c)).alias(c)

    new_type = F.coalesce(F.col("b_confirmed_type"), F.col("s_tender_type"), F.lit(K.UNKNOWN))
    return j.select(
        F.coalesce(F.col("s_id"), F.col("b_new_id")).alias("id"),
        F.when(known, F.col("s_source")).otherwise(F.col("b_source")).alias("source"),
        F.when(known, F.col("s_external_id")).otherwise(F.col("b_external_id")).alias("external_id"),
        upd("title"),
        F.coalesce(F.col("s_url"), F.col("b_url")).alias("url"),
        upd("description"), upd("posted_date"), upd("deadline"),
        F.coalesce(F.col("s_first_seen"), ts).alias("first_seen"),
        F.when(touched, ts).otherwise(F.col("s_last_checked")).alias("last_checked"),
        upd("categories"),
        F.when(touched, hits_json(F.col("b_categories"))).otherwise(F.col("s_keyword_hits")).alias("keyword_hits"),
        F.col("s_score").alias("score"), F.col("s_ai_reason").alias("ai_reason"),
        F.col("s_is_research").alias("is_research"),
        F.when(touched, new_type).otherwise(F.col("s_tender_type")).alias("tender_type"),
    )


def new_vs_known(store: DataFrame, batch: DataFrame) -> DataFrame:
    """Counts of batch records and of batch urls already stored / new.

    The batch is reduced to its distinct urls (partial aggregation) before one
    left join with the store's url column."""
    keys = batch.groupBy("url").agg(F.count(F.lit(1)).alias("_n"))
    flagged = keys.join(store.select("url", F.lit(True).alias("_known")), "url", "left")
    return flagged.agg(F.sum("_n").cast("long").alias("batch_records"),
                       F.count_if(F.col("_known").isNotNull()).cast("long").alias("known_urls"),
                       F.count_if(F.col("_known").isNull()).cast("long").alias("new_urls"))


# --------------------------------------------------------------------------
# snapshots and the additive schema

COLUMN_DEFAULTS = {"tender_type": K.UNKNOWN}


def backfill_columns(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Add columns a snapshot written before they existed lacks, with their
    default (idempotent: present columns are left alone, NULLs included)."""
    defaults = COLUMN_DEFAULTS if defaults is None else defaults
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path for ``path`` (local, HDFS or object store)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def snapshot_versions(spark: SparkSession, root: str) -> list:
    """Complete snapshot versions under ``root`` (a ``v=<n>`` folder with _SUCCESS)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


# ---- buckets

BUCKETS = 16          # of a new store, unless it is told; a bucket should hold some 100 MB
LAYOUT = "_layout"


class Conflict(RuntimeError):
    """Another writer has published the version."""


def bucket_of(url: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


@dataclass
class Snapshot:
    """A version of a store: for each bucket the version whose folder holds it
    (None: empty), the greatest id, and the last batch of each stream that is in
    it. Without ``at`` the version is one of no buckets, written whole."""
    spark: SparkSession
    root: str
    version: int | None
    at: list | None
    max_id: int | None
    streams: dict = field(default_factory=dict)
    new_buckets: int = BUCKETS   # of the next version, if this one has none

    def read(self, buckets: list | None = None) -> DataFrame:
        """The rows, or those of some buckets."""
        if self.version is None:
            return empty_store(self.spark)
        if self.at is None:
            return read_version(self.spark, self.root, self.version)
        wanted = range(len(self.at)) if buckets is None else buckets
        paths = [os.path.join(self.root, f"v={self.at[b]}", f"bucket={b}") for b in wanted if self.at[b] is not None]
        return self.spark.read.schema(STORE).parquet(*paths) if paths else empty_store(self.spark)

    @property
    def buckets(self) -> int:
        return len(self.at) if self.at is not None else self.new_buckets

    def touched(self, rows: DataFrame) -> list:
        """The buckets that the urls of ``rows`` are in: all of them, if the
        version has none yet."""
        if self.at is None and self.version is not None:
            return list(range(self.buckets))
        found = rows.select(bucket_of("url", self.buckets).alias("b")).distinct().collect()  # no more than buckets
        return sorted(r["b"] for r in found)

    def but(self, buckets: list, new: DataFrame) -> DataFrame:
        """The rows with those of some buckets replaced by ``new``."""
        if self.at is None:
            return new
        gone = set(buckets)
        return self.read([b for b in range(len(self.at)) if b not in gone]).unionByName(new)

    def publish(self, new: DataFrame, buckets: list, streams: dict | None = None, first: int = 0) -> "Snapshot":
        """Write ``new``, all rows of ``buckets``, as the next version."""
        n = self.buckets
        version = first if self.version is None else self.version + 1
        draft = os.path.join(self.root, "_drafts", uuid.uuid4().hex)
        # a bucket of more rows than a task should write is written by several
        rows = new.withColumn("bucket", bucket_of("url", n)).hint("rebalance", "bucket")
        rows.write.partitionBy("bucket").parquet(draft)
        fs, p = _fs(self.spark, draft)
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        held = {int(x[7:]) for x in names if x.startswith("bucket=")}
        at = list(self.at or [None] * n)
        for b in buckets:
            at[b] = version if b in held else None
        top = self.spark.read.parquet(draft).agg(F.max("id")).first()[0] if held else None  # from the footers
        known = [x for x in (top, self.max_id, 0) if x is not None]
        done = Snapshot(self.spark, self.root, version, at, max(known), {**self.streams, **(streams or {})})
        write_text(self.spark, os.path.join(draft, LAYOUT), json.dumps({"at": at, "max_id": done.max_id, "streams": done.streams}))
        rename_new(self.spark, draft, os.path.join(self.root, f"v={version}"))
        return done


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that must be free; :class:`Conflict` if it isn't."""
    jvm = spark._jvm
    fs, _ = _fs(spark, target)
    old, new = (fs.makeQualified(jvm.org.apache.hadoop.fs.Path(x)) for x in (source, target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(old, new, options)
    except Exception as e:
        if fs.exists(new):
            raise Conflict(target) from e
        raise


def latest(spark: SparkSession, root: str, version: int | None = None, buckets: int = BUCKETS) -> Snapshot:
    """The last published version (or a given one). ``buckets`` is for a store
    that has none yet."""
    versions = snapshot_versions(spark, root)
    if not versions:
        return Snapshot(spark, root, None, None, 0, new_buckets=buckets)
    v = versions[-1] if version is None else version
    said = read_text(spark, os.path.join(root, f"v={v}", LAYOUT))
    if said is None:
        return Snapshot(spark, root, v, None, None, new_buckets=buckets)
    layout = json.loads(said)
    return Snapshot(spark, root, v, layout["at"], layout["max_id"], layout["streams"])


def apply_touched(spark: SparkSession, root: str, change: Callable[[Snapshot], tuple | None], streams: dict | None = None,
                  first: int = 0, attempts: int = 10, buckets: int = BUCKETS) -> Snapshot:
    """Publish a change of the latest version. ``change(snapshot)`` gives (new
    rows, buckets) or None for no change; when another writer publishes before,
    it is asked again for the version that one wrote."""
    for attempt in range(attempts):
        base = latest(spark, root, buckets=buckets)
        made = change(base)
        if made is None:
            return base
        try:
            return base.publish(*made, streams, first)
        except Conflict:
            if attempt == attempts - 1:
                raise
    return base


def read_store(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Latest (or given) snapshot, with missing columns backfilled."""
    return latest(spark, root, version).read()


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A snapshot that was written whole, maybe before some columns existed."""
    df = backfill_columns(spark.read.parquet(os.path.join(root, f"v={version}")))
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in STORE.fields])


def write_store(df: DataFrame, root: str, version: int) -> str:
    """Write a snapshot version whole and without buckets; refuses to overwrite
    an existing one."""
    path = os.path.join(root, f"v={version}")
    df.write.mode("errorifexists").parquet(path)
    return path


# --------------------------------------------------------------------------
# bucketed store tables: the upsert join then shuffles only the batch side

def write_store_table(df: DataFrame, table: str, buckets: int, mode: str = "errorifexists") -> str:
    """Write a store version as a catalog table bucketed and sorted by url.

    With the store bucketed by the join key, the full outer join of an upsert
    reads each bucket in place and only the (small, folded) batch is
    shuffled into the store's bucket layout."""
    (df.write.mode(mode).format("parquet").bucketBy(buckets, "url").sortBy("url").saveAsTable(table))
    return table


def read_store_table(spark: SparkSession, table: str) -> DataFrame:
    return backfill_columns(spark.table(table))
