"""Approximate nearest neighbours: a forest of random-projection trees searched
through one priority queue, then exact reranking of the leaves' vectors.

Alike vectors are first put together into numbered points, with the few smallest
ids that a result can name, so thousands of copies are one point of the index.
A forest is fit for each length of vectors on the driver, on at most ``SAMPLE``
points in all, each length with its share of them: each node projects on the
difference of two of its points and splits at the median. Every point is then
dealt to its leaf of each tree. A query walks the trees of its length through
one queue, the node that its path leaves by the least margin first, until the
leaves it has met hold a share of the sample. Leaves and queries meet by leaf
number; in each, exact distances in double precision keep the query's nearest,
and a top-k over its leaves is the result. A length with few points has one
leaf, which its queries search whole.

The forests' size is bounded by the sample's. A leaf holds about N / leaves
points; above ``BLOCK`` it is dealt into blocks by number. Leaves (or blocks)
are gathered in buckets of about ``2 * BLOCK`` points, in which a query is
answered at once: it gets the points of ``k + 1`` ids a bucket, however many
leaves it meets there.

The share that is searched decides the recall, and with it the work: queries
that are a fixed share of the rows and meet a fixed share of the points cost the
square of the table. It is set for vectors without any structure, as random
ones, of which a third must be met for nine of ten neighbours; vectors with
structure need far less.

Defined cases: rows without vec_id take no part, nor do vectors that are null,
empty, zero or hold null or non-finite components. Vectors are compared with
those of their own length; there may be any number of lengths. Repeated rows
count once; a vec_id with several vectors stands at the nearest of them, and
asks with each; a query never finds its own vec_id. With fewer candidates than k
all are returned. Ties go to the smaller vec_id. Extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import staged

K = 10
SAMPLE = 65_536
TREES = 6
LEAF = 32         # of the sample
SHARE = 1.0       # of the sample, in the leaves that a query meets (a point counts in each tree)
LEAST = 2000      # points met at least
BLOCK = 20_000
ASKED = 64        # queries that a task searches for


class Forest:
    """Complete binary trees; node i has children 2i + 1 and 2i + 2."""

    def __init__(self, points: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11):
        n, dim = points.shape
        self.depth = max(0, int(np.log2(max(1, n / leaf))))
        self.n_leaves = 1 << self.depth
        inner = self.n_leaves - 1
        rng = np.random.default_rng(seed)
        self.ways = np.zeros((trees, inner, dim))
        self.cuts = np.zeros((trees, inner))
        self.counts = np.zeros((trees, self.n_leaves), np.int64)
        for t in range(trees):
            node = np.zeros(n, np.int64)
            for d in range(self.depth):
                first = (1 << d) - 1
                order = np.argsort(node, kind="stable")
                ends = np.searchsorted(node[order], np.arange(first, first + (1 << d) + 1))
                for i in range(1 << d):
                    own = order[ends[i]:ends[i + 1]]
                    if len(own) > 1:
                        a, b = rng.choice(own, 2, replace=False)
                        way = points[a] - points[b]
                    else:
                        way = rng.normal(size=dim)
                    way = way / max(np.linalg.norm(way), 1e-300)
                    self.ways[t, first + i] = way
                    self.cuts[t, first + i] = np.median(points[own] @ way) if len(own) else 0.0
                node = self._down(points, node, t)
            self.counts[t] = np.bincount(node - inner, minlength=self.n_leaves)

    def _down(self, points, node, t):
        side = np.einsum("ij,ij->i", points, self.ways[t, node]) > self.cuts[t, node]
        return 2 * node + 1 + side

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """The leaf number of each point in each tree, unlike between trees."""
        out = np.zeros((len(points), len(self.ways)), np.int64)
        for t in range(len(self.ways)):
            node = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                node = self._down(points, node, t)
            out[:, t] = node - (self.n_leaves - 1) + t * self.n_leaves
        return out

    def search(self, q: np.ndarray, wanted: float) -> list[int]:
        """Leaves of all trees, nearest first, until they hold ``wanted``."""
        inner, found, met = self.n_leaves - 1, [], 0
        queue = [(0.0, t, 0) for t in range(len(self.ways))]
        while queue and met < wanted:
            off, t, node = heapq.heappop(queue)
            while node < inner:  # down on the query's side, the other waits
                margin = float(q @ self.ways[t, node]) - self.cuts[t, node]
                near = 2 * node + 1 + (margin > 0)
                heapq.heappush(queue, (off + margin * margin, t, 4 * node + 3 - near))
                node = near
            found.append(t * self.n_leaves + node - inner)
            met += int(self.counts[t, node - inner])
        return found


def first_ids(ids: pa.Array) -> np.ndarray:
    """The first id of each list; lists are never empty."""
    return ids.flatten().to_numpy()[np.cumsum(np.concatenate([[0], np.diff(ids.offsets.to_numpy())[:-1]])).astype(np.int64)] if len(ids) else np.zeros(0, np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def valid_vectors(df: DataFrame, vector: str) -> DataFrame:
    """(vec_id, v array<double>, dim), each once."""
    v = df[vector].cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = df["vec_id"].isNotNull() & (F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0)
    return df.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()


def nearest(df: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding", sample: int = SAMPLE,
            trees: int = TREES, leaf: int = LEAF, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors found nearest to each
    row of ``queries``, both with vec_id and ``vector`` columns."""
    rows = valid_vectors(df, vector)
    smallest = W.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
    points = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = staged(points.select(F.monotonically_increasing_id().alias("point"), F.size("v").alias("dim"), "v", "ids"), "ann-points")
    asked = staged(valid_vectors(queries, vector).select(F.col("vec_id").alias("query_id"), F.size("v").alias("dim"), "v"), "ann-queries")
    sizes = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a number a length
    found = _met(points, asked, sizes, k, sample, trees, leaf, share)
    each = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where(F.col("vec_id") != F.col("query_id"))
    # a vec_id with several vectors stands at its nearest
    each = each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fit_forests(points: DataFrame, n: int, sample: int, trees: int, leaf: int) -> dict[int, Forest]:
    """A forest for each length of which the sample holds more than a leaf."""
    drawn = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / float(1 << 30)
    taken = points.where(drawn < min(1.0, 1.0 * sample / max(1, n))).select("v").limit(sample + sample // 16).toPandas()
    by_length: dict[int, list] = {}
    for v in taken["v"]:
        by_length.setdefault(len(v), []).append(v)
    out = {}
    for dim, vs in by_length.items():
        if len(vs) > leaf:
            m = np.stack(vs)
            out[dim] = Forest(m[np.lexsort(m.T[::-1])], trees, leaf)  # the order rows come in doesn't matter
    return out


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) of the vectors of each length."""
    sizes = np.diff(column.offsets.to_numpy())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, _matrix(column.take(pa.array(at)), int(dim))


def _met(points: DataFrame, asked: DataFrame, sizes: dict, k: int, sample: int, trees: int, leaf: int, share: float) -> DataFrame:
    """(query_id, score, ids) of points that queries met, the nearest of each
    bucket."""
    spark = points.sparkSession
    n = sum(sizes.values())
    forests = fit_forests(points, n, sample, trees, leaf)
    plans = {}  # length -> (forest or None, points that a query has to meet, blocks of a leaf)
    for dim, size in sizes.items():
        f = forests.get(dim)
        plans[dim] = (f, max(share * f.counts[0].sum(), LEAST) if f else 0, max(1, -(-size // ((f.n_leaves if f else 1) * BLOCK))))
    shared = spark.sparkContext.broadcast(plans)
    buckets = max(1, -(-n * trees // (2 * BLOCK)))

    def bucket(dim, cells, block):
        return ((cells * 0x9E3779B1 + block * 0x85EBCA6B + dim * 0xC2B2AE35) & 0x7FFFFFFF) % buckets

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, at, m in by_length(b.column("v")):
                f, _, blocks = shared.value[dim]
                rows = b.take(pa.array(at))
                cells = f.leaves(m) if f else np.zeros((len(at), 1), np.int64)
                block = rows.column("point").to_numpy() * 0x2545F491 % (1 << 40) // 131 % blocks
                for t in range(cells.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(bucket(dim, cells[:, t], block)), pa.array(cells[:, t]), *rows.columns],
                                                     names=["bucket", "cell", *rows.schema.names])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, at, m in by_length(b.column("v")):
                if dim not in shared.value:
                    continue
                f, wanted, blocks = shared.value[dim]
                who, where, what = [], [], []
                for i, q in zip(at, m):
                    cells = np.array(f.search(q, wanted) if f else [0], np.int64)
                    places = bucket(dim, cells[:, None], np.arange(blocks)[None, :])
                    for g in np.unique(places):
                        who.append(i)
                        where.append(g)
                        what.append(cells[(places == g).any(axis=1)])
                i = pa.array(who, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), b.column("query_id").take(i), b.column("v").take(i), pa.array(what, pa.list_(pa.int64()))],
                                                 names=["bucket", "query_id", "v", "cells"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        left, right = left.combine_chunks(), right.combine_chunks()
        ids = left.column("ids").combine_chunks()
        if left.num_rows and right.num_rows:
            queries = {dim: (at, m) for dim, at, m in by_length(right.column("v").combine_chunks())}
            first = first_ids(ids)
            point, cells_of = left.column("point").to_numpy(), left.column("cell").to_numpy()
            asked_cells = right.column("cells").to_pylist()
            for dim, rows, m in by_length(left.column("v").combine_chunks()):
                if dim not in queries:
                    continue
                order = rows[np.argsort(cells_of[rows], kind="stable")]
                m = m[np.argsort(cells_of[rows], kind="stable")]
                cell = cells_of[order]
                for j, query in zip(*queries[dim]):
                    lo, hi = (np.searchsorted(cell, asked_cells[j], side) for side in ("left", "right"))
                    near = np.repeat(lo - np.cumsum(np.concatenate([[0], (hi - lo)[:-1]])), hi - lo) + np.arange((hi - lo).sum())
                    near = near[np.unique(point[order[near]], return_index=True)[1]]  # met in several trees
                    gap = m[near] - query
                    away = np.sqrt((gap * gap).sum(axis=1))
                    best = np.lexsort((first[order[near]], away))
                    for i in until(best, lambda x: ids[int(order[near[x]])].as_py(), k + 1):
                        out[0].append(right.column("query_id")[int(j)].as_py())
                        out[1].append(away[i])
                        out[2].append(order[near[i]])
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.float64()), ids.take(pa.array(out[2], pa.int64()))], names=["query_id", "score", "ids"])

    index = points.select("point", "v", "ids").mapInArrow(deal, "bucket long, cell long, point long, v array<double>, ids array<long>")
    tasks = max(1, -(-asked.count() // ASKED))
    asking = asked.select("query_id", "v").repartition(tasks, "query_id").mapInArrow(ask, "bucket long, query_id long, v array<double>, cells array<long>")
    return index.groupBy("bucket").cogroup(asking.groupBy("bucket")).applyInArrow(meet, "query_id long, score double, ids array<long>")


def until(places: np.ndarray, ids_of, wanted: int) -> Iterator[int]:
    """The places, in order, until their points name ``wanted`` different ids."""
    named: set = set()
    for i in places:
        if len(named) >= wanted:
            return
        named.update(ids_of(i))
        yield i
