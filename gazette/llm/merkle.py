"""Merkle manifest of a dataset: a root per group (source) and one over all.

A row's leaf is a hash of its columns. In a group the leaves stand in the order
of their key; every three neighbours become one hash, the last run may be
shorter, until one is left: the group's subroot. Subroots, in the order of their
groups, become the root in the same way.

The tree of a group is cut into aligned *blocks* of ``3 ** HEIGHT`` leaves, each
built in one task; the block roots are the leaves of the next tier, and so on
until a group has one block (a group of 10 ** 11 leaves has three tiers). Within
a block the nodes lie in van Emde Boas order: the tree is split at half of its
height, the top part comes first and each bottom part follows, all laid out the
same way again. Building the tree and finding siblings is arithmetic on
addresses (``Layout``), and a path from a leaf to the top stays in few pieces of
memory however large a piece is. A group with a third of all rows is merely more
blocks.

Proofs go down the tiers: each block gets the path from its root to the root of
all, as one short value, and hands every leaf (or block below) its own path. Only
hashes move, never texts.

Defined cases: nulls are hashed as ``-``; a null group is one of its own, the
first; rows without key come before the others of their group; rows with equal
keys are ordered by leaf, so repeated rows are leaves of their own and any order
among them gives the same root. A group of one leaf has it as subroot, one group
has its subroot as root. An empty table has neither groups nor a root.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordering import global_rank
from .common import staged

WAYS = 3      # nodes that become one
HEIGHT = 8    # levels of a block: 6561 leaves
SIZE = 32     # bytes of a digest
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def said(value: Column) -> Column:
    """A value with its length, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest (binary) of a row's values."""
    return F.unhex(F.sha2(F.concat(*[said(v) for v in values]), 256))


def joined(digests: list[bytes]) -> bytes:
    """The hash of digests as hex text, one after the other."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


# ---- van Emde Boas layout of a complete tree with WAYS children a node

@functools.lru_cache(maxsize=None)
def size_of(height: int) -> int:
    """Nodes of a tree with ``height`` levels below its root."""
    return (WAYS ** (height + 1) - 1) // (WAYS - 1)


def address(level: int, index: np.ndarray, height: int) -> np.ndarray:
    """Addresses of nodes ``level`` levels above the leaves, by their place in
    that level, in a tree of that height. The top half of the levels is one tree,
    laid out first; each of the trees below it follows in order."""
    if height == 0:
        return index * 0
    below = (height + 1) // 2 - 1   # height of the bottom trees
    top = height - below - 1
    if level > below:
        return address(level - below - 1, index, top)
    leaves = WAYS ** (below - level)                    # nodes of this level in a bottom tree
    which, inside = index // leaves, index % leaves
    return size_of(top) + which * size_of(below) + address(level, inside, below)


@functools.lru_cache(maxsize=32)
def level_addresses(level: int, height: int) -> np.ndarray:
    return address(level, np.arange(WAYS ** (height - level)), height)


@dataclass
class Layout:
    """A block's tree: digests by address. ``n`` leaves are there; the levels
    above hold as many nodes as their runs."""
    store: np.ndarray   # addresses x SIZE bytes
    n: int
    height: int

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> "Layout":
        t = cls(np.zeros((size_of(height), SIZE), np.uint8), len(leaves), height)
        row = leaves
        t.put(0, row)
        for level in range(1, height + 1):
            row = [joined(row[i:i + WAYS]) for i in range(0, len(row), WAYS)]
            t.put(level, row)
        return t

    def put(self, level: int, row: list[bytes]) -> None:
        self.store[level_addresses(level, self.height)[:len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, SIZE)

    def width(self, level: int) -> int:
        return -(-self.n // WAYS ** level)

    def level(self, level: int) -> list[bytes]:
        at = level_addresses(level, self.height)[:self.width(level)]
        return [x.tobytes() for x in self.store[at]]

    @property
    def top(self) -> bytes:
        return self.store[level_addresses(self.height, self.height)[0]].tobytes()

    def paths(self) -> list[bytes]:
        """For each leaf its path to the top: a step a level, which is the place
        in the run, the size of the run and the digests of the others."""
        steps = []
        for level in range(self.height):
            row, out = self.level(level), []
            for i in range(len(row)):
                first = i - i % WAYS
                run = row[first:first + WAYS]
                out.append(bytes((i - first, len(run))) + b"".join(d for k, d in enumerate(run) if first + k != i))
            steps.append(out)
        whole = [b""] * self.width(self.height)
        for level in reversed(range(self.height)):
            whole = [steps[level][i] + whole[i // WAYS] for i in range(self.width(level))]
        return whole

    def bytes(self) -> bytes:
        return self.store.tobytes()

    @classmethod
    def read(cls, store: bytes, n: int, height: int) -> "Layout":
        return cls(np.frombuffer(store, np.uint8).reshape(-1, SIZE), n, height)


def walk(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The steps of a path: place in the run, digests of the others."""
    at = 0
    while at < len(path):
        place, n = path[at], path[at + 1] - 1
        yield place, [path[at + 2 + SIZE * k:at + 2 + SIZE * (k + 1)] for k in range(n)]
        at += 2 + SIZE * n


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    for place, others in walk(path):
        digest = joined([*others[:place], digest, *others[place:]])
    return digest


def siblings(path: bytes) -> list[bytes]:
    return [d for _, others in walk(path) for d in others]


def levels_needed(n: int) -> int:
    """Levels until n nodes are one."""
    height = 0
    while WAYS ** height < n:
        height += 1
    return height


# ---- tiers of blocks

BLOCK = "grp long, block long, n_blocks long, n int, height int, store binary, top binary"


def blocks_of(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, pos, total, digest) -> a row a block of 3 ** height nodes. ``total``
    is the group's number of nodes; only a group's single block may end lower."""
    width = WAYS ** height

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = table.column("total")[0].as_py()
        leaves = [x.as_py() for x in table.column("digest")]
        t = Layout.build(leaves, levels_needed(total) if total <= width else height)
        return pa.table({"grp": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()),
                         "n_blocks": pa.array([-(-total // width)], pa.int64()), "n": pa.array([t.n], pa.int32()),
                         "height": pa.array([t.height], pa.int32()), "store": pa.array([t.bytes()], pa.binary()),
                         "top": pa.array([t.top], pa.binary())})

    block = F.expr(f"pos div {width}L").alias("block")
    return nodes.select("grp", block, "pos", "total", "digest").groupBy("grp", "block").applyInArrow(build, BLOCK)


def tiers_of(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """All tiers of blocks over (grp, pos, total, digest), lowest first; each is
    written once. The last holds blocks of groups that need that many tiers."""
    tiers = []
    while True:
        tier = staged(blocks_of(nodes, height), f"merkle-tier-{len(tiers)}")
        tiers.append(tier)
        open_ = tier.where("n_blocks > 1")
        if open_.isEmpty():
            return tiers
        nodes = open_.select("grp", F.col("block").alias("pos"), F.col("n_blocks").alias("total"), F.col("top").alias("digest"))


def tops(tiers: list[DataFrame]) -> DataFrame:
    """(grp, digest): the root of each group, found in the tier where it has one
    block."""
    out = None
    for t in tiers:
        mine = t.where("n_blocks = 1").select("grp", F.col("top").alias("digest"))
        out = mine if out is None else out.unionByName(mine)
    return out


def handed_down(tier: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path from their top (grp, block, path, tops) -> the same
    for the nodes they are made of (grp, pos, path, tops)."""

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                found = Layout.read(r["store"], r["n"], r["height"]).paths()
                first = r["block"] * WAYS ** r["height"]
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([r["grp"]] * len(found), pa.int64()), "pos": pa.array(range(first, first + len(found)), pa.int64()),
                    "path": pa.array([p + r["path"] for p in found], pa.binary()), "tops": pa.array([r["tops"]] * len(found), pa.binary())})

    with_path = tier.join(paths, ["grp", "block"]).select("grp", "block", "n", "height", "store", "path", "tops")
    return with_path.mapInArrow(hand, "grp long, pos long, path binary, tops binary")


def block_paths(tiers: list[DataFrame], group_paths: DataFrame) -> DataFrame:
    """(grp, path, tops) -> the same for each block of the lowest tier: the path
    from its top on. ``tops`` is handed down unchanged."""
    paths = None
    for i, t in reversed(list(enumerate(tiers))):
        done = t.where("n_blocks = 1").select("grp", "block").join(group_paths, "grp").select("grp", "block", "path", "tops")
        paths = done if paths is None else done.unionByName(paths)
        if i:
            paths = handed_down(t, paths).select("grp", F.col("pos").alias("block"), "path", "tops")
    return paths


@dataclass
class Manifest:
    """The leaves (row columns of the key, grp, pos, total, digest and what was
    kept with them), the tiers of blocks of all groups, the groups (grp, the
    group's value, first, total) and the tiers over their subroots."""
    leaves: DataFrame
    tiers: list[DataFrame]
    groups: DataFrame
    root_tiers: list[DataFrame]
    height: int = HEIGHT

    def root(self) -> DataFrame:
        """One row: the root of all."""
        return tops(self.root_tiers).select(F.lower(F.hex("digest")).alias("root"))

    def subroots(self) -> DataFrame:
        """A row a group."""
        return tops(self.tiers).join(self.groups, "grp").select("value", "total", F.lower(F.hex("digest")).alias("subroot"))

    def proofs(self, told: Column | None = None) -> DataFrame:
        """The leaves with subroot, root, proof (the siblings) and folded, the
        root that a digest and its siblings give. The digest is the leaf's own or
        what ``told``, over the leaves' columns, says."""
        over = block_paths(self.root_tiers, tops(self.root_tiers).select("grp", F.lit(b"").alias("path"), F.col("digest").alias("tops")))
        of_group = handed_down(self.root_tiers[0], over).select(F.col("pos").alias("place"), "path", "tops")
        own = tops(self.tiers)
        groups = self.groups.join(of_group, "place").join(own, "grp").select("grp", "path", F.concat("digest", "tops").alias("tops"))
        lowest = block_paths(self.tiers, staged(groups, "merkle-groups"))
        blocks = self.tiers[0].join(lowest, ["grp", "block"]).select("grp", "block", "n", "height", "store", "path", "tops")
        width = WAYS ** self.height
        kept = [c for c in self.leaves.columns if c not in ("grp", "pos", "total")]
        rows = self.leaves.select("grp", F.expr(f"pos div {width}L").alias("block"), "pos", *kept, (F.col("digest") if told is None else told).alias("told"))
        types = {f.name: f.dataType.simpleString() for f in self.leaves.schema.fields}
        schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", subroot binary, root binary, proof binary, folded binary"

        def prove(table: pa.Table, block: pa.Table) -> pa.Table:
            r = block.to_pylist()[0]
            steps = Layout.read(r["store"], r["n"], r["height"]).paths()
            paths = [steps[p % width] + r["path"] for p in table.column("pos").to_pylist()]
            folded = [fold(d.as_py(), p) for d, p in zip(table.column("told"), paths)]
            n = len(paths)
            out = {c: table.column(c) for c in kept}
            out |= {"subroot": pa.array([r["tops"][:SIZE]] * n, pa.binary()), "root": pa.array([r["tops"][SIZE:]] * n, pa.binary()),
                    "proof": pa.array([b"".join(siblings(p)) for p in paths], pa.binary()), "folded": pa.array(folded, pa.binary())}
            return pa.table(out)

        return rows.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block")).applyInArrow(prove, schema)


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple = COLUMNS, keep: dict | None = None,
             height: int = HEIGHT) -> Manifest:
    """The manifest of ``docs``; ``keep`` names expressions over its columns that
    stay with the leaves."""
    spark = docs.sparkSession
    more = keep or {}
    rows = docs.select(docs[key].alias("key"), docs[group].alias("value"), leaf(*[docs[c] for c in columns]).alias("digest"),
                       *[e.alias(n) for n, e in more.items()], F.monotonically_increasing_id().alias("tie"))
    rows = staged(rows, "merkle-leaves")
    ranked = staged(global_rank(rows, [F.col("value").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest"), F.col("tie")]), "merkle-ranked")
    groups = ranked.groupBy("value").agg(F.min("rank").alias("grp"), F.count(F.lit(1)).alias("total"))
    groups = staged(global_rank(groups, [F.col("grp")], out="place").withColumn("place", F.col("place") - 1), "merkle-sources")
    leaves = ranked.join(groups.withColumnRenamed("value", "of"), F.col("value").eqNullSafe(F.col("of"))).select(
        "key", "value", "grp", (F.col("rank") - F.col("grp")).alias("pos"), "total", "digest", *more)
    leaves = staged(leaves, "merkle-placed")
    tiers = tiers_of(leaves.select("grp", "pos", "total", "digest"), height)
    n = groups.count()
    nodes = tops(tiers).join(groups, "grp").select(F.lit(0).cast("long").alias("grp"), F.col("place").alias("pos"), F.lit(n).cast("long").alias("total"), "digest")
    return Manifest(leaves, tiers, groups, tiers_of(nodes, height), height)
