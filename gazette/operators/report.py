"""Publishing: the active board, category tabs, the monthly archive.

Order is part of these reports, and the comparison of results ignores row
order, so each report carries its position as a column. Positions come from
``global_rank`` (range partitioning + per-partition offsets), never from an
unpartitioned window over the whole table. Month groups are ranked on the
aggregated months — at most twelve rows per calendar year — and joined back
with a broadcast of that bounded table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import ts_lit

from .. import constants as K
from ..functions import dates as D
from ..functions.text import html_escape
from .ordering import global_rank
from .taxonomy import category_flag, category_tags



def with_flags(df: DataFrame, categories: list) -> DataFrame:
    return df.select("*", *[category_flag(F.col("categories"), c).alias(f"flag_{c}") for c in categories])


def active_filter(as_of: _dt.date, min_score: float = K.ACTIVE_MIN_SCORE,
                  excluded_type: str = K.EXCLUDED_FROM_BOARD_TYPE):
    """Deadline not passed (NULL passes), score present and >= min, type not
    the excluded one (NULL and unknown pass)."""
    dl = F.col("deadline")
    return ((dl.isNull() | (dl >= F.lit(as_of)))
            & F.col("score").isNotNull() & (F.col("score") >= min_score)
            & ~F.coalesce(F.col("tender_type") == excluded_type, F.lit(False)))


def active_order():
    """Deadline soonest first (none last), then score high to low, then newest id."""
    return [F.col("deadline").asc_nulls_last(), F.col("score").desc_nulls_last(), F.col("id").desc()]


def archive_order():
    """Posted newest first (none last), then newest id."""
    return [F.col("posted_date").desc_nulls_last(), F.col("id").desc()]


def active_board(store: DataFrame, as_of: _dt.date, categories: list, labels: dict) -> DataFrame:
    """Active rows in board order with badge, score band and tags."""
    act = with_flags(store.filter(active_filter(as_of)), categories)
    flags = [F.col(f"flag_{c}") for c in categories]
    act = act.select("*", D.deadline_badge("deadline", as_of).alias("badge"),
                     D.score_band("score").alias("band"),
                     category_tags(flags, [labels[c] for c in categories]).alias("tags"))
    return ranked(act, active_order(), ["deadline", "score"], "board_rank").select(*act.columns, "board_rank")


def ranked(rows: DataFrame, order: list, keys: list, out: str, how: str | None = None) -> DataFrame:
    """``rows`` with their place in an order of ``keys`` and id. Only these
    columns are sorted and checkpointed; the place then meets its row by id
    (``how``: a join hint)."""
    places = global_rank(rows.select("id", *keys), order, out=out).select("id", out)
    return rows.join(places.hint(how) if how else places, "id")


def tab_rows(board: DataFrame, categories: list) -> DataFrame:
    """One row per (tab, active row with that flag), board order kept as board_rank."""
    tabs = F.filter(F.array(*[F.when(F.col(f"flag_{c}"), F.lit(c)) for c in categories]), lambda x: x.isNotNull())
    return board.select(F.explode(tabs).alias("tab"), "board_rank", "id")


def tab_counts(board: DataFrame, categories: list) -> DataFrame:
    """All active rows, and per category (a row counts in each of its categories)."""
    return board.agg(F.count(F.lit(1)).alias("n_all"),
                     *[F.count_if(F.col(f"flag_{c}")).alias(f"n_{c}") for c in categories])


def month_groups(store: DataFrame) -> DataFrame:
    """Months present, newest first, unknown last: label, rank and row count."""
    m = store.groupBy(F.trunc("posted_date", "month").alias("month")).agg(F.count(F.lit(1)).alias("month_count"))
    w = Window.orderBy(F.col("month").desc_nulls_last())
    return m.select("month", D.month_label("month").alias("month_label"),
                    F.dense_rank().over(w).cast("long").alias("month_rank"), "month_count")


def archive(store: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """All rows in archive order with their month group."""
    groups = month_groups(store)
    rows = store.withColumn("month", F.trunc("posted_date", "month"))
    rows = rows.join(F.broadcast(groups), rows["month"].eqNullSafe(groups["month"]), "left") \
        .drop(groups["month"]).drop("month")
    rows = rows.select("*", D.date_or_dash("deadline").alias("deadline_text"),
                       D.score_band("score").alias("band"),
                       html_escape("title").alias("title_html"),
                       D.run_stamp(ts_lit(run_ts)).alias("generated_at"))
    # the whole store: its wide rows aren't sorted for the join
    return ranked(rows, archive_order(), ["posted_date"], "archive_rank", "shuffle_hash").select(*rows.columns, "archive_rank")


def month_counts(store: DataFrame) -> DataFrame:
    g = month_groups(store)          # bounded: one row per calendar month present
    total = F.sum("month_count").over(Window.partitionBy(F.lit(1)))
    return g.select("month_label", "month_rank", F.col("month_count").cast("long").alias("month_count"),
                    total.cast("long").alias("total_count"))


def publish(board: DataFrame, archive_rows: DataFrame, out_dir: str, mode: str = "overwrite") -> dict:
    """Report sinks (A11): the board as Parquet and JSON lines, the archive as
    Parquet partitioned by month label (one folder per month group)."""
    import os
    paths = {"board": os.path.join(out_dir, "board"), "board_json": os.path.join(out_dir, "board_json"),
             "archive": os.path.join(out_dir, "archive")}
    board.write.mode(mode).parquet(paths["board"])
    board.select(*[c for c in board.columns if c != "categories"]).write.mode(mode).json(paths["board_json"])
    archive_rows.write.mode(mode).partitionBy("month_label").parquet(paths["archive"])
    return paths
