"""Order-dependent helpers that stay distributed.

``global_rank`` numbers rows 1..n in a total order without an unpartitioned
window (which would pull every row into one task): the rows are range
partitioned on the order keys and sorted within partitions, each row gets
``monotonically_increasing_id`` (partition id in the upper bits, position in
the lower bits), and a per-partition count table — one row per partition, a
bounded size of at most 2^31 rows of two numbers, since
``monotonically_increasing_id`` has 31 bits for the partition — gives each
partition its offset. The sorted frame is checkpointed first so both passes
see the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = 33


def global_rank(df: DataFrame, order: list, out: str = "rank",
                partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` (must be a
    total order, e.g. ending in a unique key)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    sorted_df = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        ensure_checkpoint_dir(spark)
        sorted_df = sorted_df.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), _LOW_BITS)
    counts = sorted_df.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    low = F.col("_mid") - F.shiftleft(F.shiftright(F.col("_mid"), _LOW_BITS), _LOW_BITS)
    return (sorted_df.withColumn("_pid", part)
            .join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + low + F.lit(1))
            .drop("_pid", "_off", "_mid"))


def keep_first(df: DataFrame, key, order: str = "ord") -> DataFrame:
    """Keep-first dedup by ``key`` in ``order``.

    One aggregate with map-side partial ``min_by``: a key holding a third of
    all rows is collapsed in every map task before the shuffle, so no task
    receives the hot group whole."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col("_first." + c).alias(c) for c in rest])
