"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out to ``partitions`` tasks (the cores, by default), ahead of
    remote or very slow work a row on a small input."""
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


ROWS_A_TASK = 100_000   # of a plain scan that is rendered or parsed


def spread_rows(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A plain scan dealt out to all cores, and to so many tasks that each has
    some ``rows`` (``ROWS_A_TASK``) of it: what a task sorts or holds doesn't grow with the table.
    The rows are counted first, which for Parquet takes the footers only."""
    return spread_scan(df, max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // (rows or ROWS_A_TASK))))


def spread_scan(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """A scan of fewer splits than cores dealt out to all cores (the test tables
    are one row group each). Scans of many splits stay as they are. Runs no job."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    return spread(df, n) if df._jdf.queryExecution().toRdd().getNumPartitions() < n else df
