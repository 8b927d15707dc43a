"""Connected components of a table of links, by alternating stars.

Each round moves every link to the least neighbour: first the larger neighbours
of a node (large star), then the smaller ones (small star). Rounds end when
all links are stars; their number grows with the logarithm of the longest chain. Links
and nodes stay in Spark. Least neighbours are pre-aggregated in each task, and
the join back on a node with very many links is one that Spark can split, since
both sides are written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged


def _done(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none."""
    roles = links.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(links.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    roles = roles.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return roles.where((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0))).isEmpty()


def _star(links: DataFrame, large: bool) -> DataFrame:
    least = staged(links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m")), "least")
    both = links.join(least, links["u"] == least["at"])
    if large:
        moved = both.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.where(F.col("at") != F.col("m")).select(F.col("at").alias("u"), F.col("m").alias("v")))
    return staged(moved.where(F.col("u") != F.col("v")).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (node, label): the least node that each
    node is connected to; nodes without a link to another aren't listed."""
    now = staged(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _done(now):
        now = _star(now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), large=True)
        now = _star(now, large=False)  # every link is from the larger node
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionAll(labels.select(F.col("label").alias("node"), "label").distinct())
