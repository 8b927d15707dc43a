"""N-gram Jaccard join: which documents share three quarters of their shingles.

1. Each chunk asks how many documents hold each of its shingles, so that all
   documents order their shingles alike, the rarest first.
2. A document of n shingles must share at least T = 75 % of n with a partner.
   So a partner is in one of the lists of its n - T + 1 rarest shingles. Only
   these short lists are built, and only of shingles that are met twice; long
   lists are never merged. Documents with the same set are one from here on.
3. Documents that share a short list are put together: connected components of
   these (unverified) links. What is linked can only be within one.
4. Each component is solved exactly, by T-occurrence search: for a document the
   short lists are heap-merged, and each candidate is probed by binary search
   for the shingles of the long lists, in DivideSkip's manner, until it reaches
   the overlap that both sizes ask for or no longer can. Candidates that are
   linked already are skipped.
5. What a component's one task links is final. Links found in blocks of a large
   component, a spanning forest each, are joined to components once more.

Hot groups: a component of more than ``BLOCK`` shingles is dealt into blocks.
Each block is solved together with a few hub documents of the component, which
joins groups of copies across blocks; after that only documents outside the
largest group so far are compared with all blocks, block by block. Pairs are
never listed: a task yields fewer links than it has documents.

Shingles are 64-bit hashes of five 64-bit word hashes; frequencies are counted
on their highest 40 bits, which bears on the order only.

Defined cases: texts without words (null, empty, blank) have an empty set and
are linked with nothing; a text of one to four words has one shingle. Rows
count as documents, whatever their doc_id; a component without any doc_id has
none. Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from .chunks import REQUEST, answers, grams, mixed, read_answers, requests, stage
from .common import staged
from .components import components
from .substring import Words

WORDS = 5
SIMILAR = 75          # percent
KEYS_A_BYTE = 0.17
COUNT_BYTES = 5
BLOCK = 500_000       # shingles solved together
HUBS = 8

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 33            # rows are numbered within a task's share of the documents

POSTING = "kind int, shingle long, row long, chunk long, doc_id long, n long, s1 long, s2 long"
SET = "grp long, blk long, oblk long, role int, row long, label long, shingles binary"


class Shingles:
    """The shingle sets of a chunk's documents, sorted, end to end."""

    def __init__(self, table: pa.Table):
        w = FoldedWords(table)
        self.chunk, self.doc_id = w.chunk, w.doc_id
        table = table.sort_by("ord")
        self.row = (self.chunk >> _BASE << _BASE) | table.column("ord").to_numpy()
        doc, gram = [], []
        start = w.windows(WORDS)
        count = np.maximum(0, w.last - w.first - WORDS + 1)
        doc.append(np.repeat(np.arange(len(count)), count))
        gram.append(grams(w.hash, WORDS)[start])
        few = np.flatnonzero((w.last > w.first) & (count == 0))
        if len(few):
            doc.append(few)
            gram.append(np.array([short_shingle(w.hash[w.first[i]:w.last[i]]) for i in few], np.uint64))
        doc, gram = np.concatenate(doc), np.concatenate(gram)
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        self.doc, self.gram = doc[new], gram[new]
        self.n = np.bincount(self.doc, minlength=len(self.row))

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set."""
        begin = np.cumsum(self.n) - self.n
        out = []
        for salt in (1, 2):
            s = np.zeros(len(self.n), np.uint64)
            full = self.n > 0
            if full.any():
                s[full] = np.add.reduceat(mixed(self.gram ^ mixed(np.full(1, salt, np.uint64))), begin[full])
            out.append(mixed(s + self.n.astype(np.uint64)))
        return out[0].view(np.int64), out[1].view(np.int64)


class FoldedWords(Words):
    """Words with A-Z lower-cased."""

    def __init__(self, table: pa.Table):
        super().__init__(table, _FOLD)


def short_shingle(words: np.ndarray) -> np.uint64:
    """The one shingle of a text of fewer than five words."""
    h = np.full(1, len(words), np.uint64)
    for w in words:
        h = mixed(h ^ w) * np.uint64(0x9E3779B97F4A7C15)
    return h[0]


def counted(gram: np.ndarray) -> np.ndarray:
    """The part of a shingle that is counted."""
    return gram & ~np.uint64((1 << (64 - 8 * COUNT_BYTES)) - 1)


def level(_, total: np.ndarray) -> np.ndarray:
    """A byte that rises with a frequency; 1: met once."""
    high = 128 + np.minimum(127, 8 * np.log2(np.maximum(total, 128) / 128.0))
    return np.where(total < 128, total, high).astype(np.uint8)


def least_overlap(n: int) -> int:
    """Shingles that a set of n shares with any similar set, at least."""
    return -(-SIMILAR * n // 100)


class Solver:
    """T-occurrence search among some documents; links them as it finds."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray):
        self.sets = sets
        self.parent = {}
        self.label = labels
        every = np.concatenate([np.zeros(0, np.uint64), *sets])
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(every, kind="stable")
        self.found, begin = np.unique(every[order], return_index=True)
        self.lists = np.split(doc[order], begin[1:]) if len(begin) else []

    def root(self, x):
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def links(self, ask: np.ndarray) -> list[tuple[int, int]]:
        """A spanning forest of the links between the ``ask`` documents and all."""
        out = []
        for x in ask:
            own = self.sets[x]
            if not len(own):
                continue
            mine = [self.lists[i] for i in np.searchsorted(self.found, own)]
            length = np.array([len(v) for v in mine])
            by = np.argsort(length, kind="stable")
            n_short = len(own) - least_overlap(len(own)) + 1
            short, rest = by[:n_short], own[np.sort(by[n_short:])]
            merged = heapq.merge(*[mine[i].tolist() for i in short if length[i] > 1])
            for y, hits in groupby(merged):
                if y == x or self.root(("l", self.label[x])) == self.root(("l", self.label[y])):
                    continue
                a, b, hit = len(own), len(self.sets[y]), sum(1 for _ in hits)
                if min(a, b) * 100 < SIMILAR * max(a, b):
                    continue
                wanted = -(-SIMILAR * (a + b) // (100 + SIMILAR))  # 100 i >= 75 (a + b - i)
                if hit + len(rest) < wanted:
                    continue
                other = self.sets[y]
                place = np.minimum(np.searchsorted(other, rest), b - 1)
                if hit + int((other[place] == rest).sum()) >= wanted:
                    out.append((int(x), int(y)))
                    self.parent[self.root(("l", self.label[x]))] = self.root(("l", self.label[y]))
        return out


def solve(table: pa.Table) -> pa.Table:
    """Links of one group: documents of role 1 are asked, those of role 0 only
    found. Each is given as a link to the least row of its tree."""
    table = table.sort_by([("row", "ascending"), ("role", "descending")])
    row = table.column("row").to_numpy()
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]  # a hub may be in its own block
    table = table.filter(pa.array(new))
    row, role = table.column("row").to_numpy(), table.column("role").to_numpy()
    s = Solver([np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")], table.column("label").to_numpy())
    up = np.arange(len(row))
    for x, y in s.links(np.flatnonzero(role == 1)):
        x, y = _top(up, x), _top(up, y)
        up[max(x, y)] = min(x, y)
    linked = [(int(row[_top(up, i)]), int(row[i])) for i in range(len(row)) if up[i] != i]
    return pa.table({"a": pa.array([a for a, _ in linked], pa.int64()), "b": pa.array([b for _, b in linked], pa.int64())})


def _top(up: np.ndarray, x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def jaccard_join(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row a row of ``docs``: doc_id, n_shingles and component_id (the least
    doc_id that links lead to)."""
    return joined(stage(docs, text)).select("doc_id", "n_shingles", "component_id")


def distinct_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id (a row
    without doc_id only if none has one). Texts without words all stay."""
    others = [c for c in docs.columns if c.lower() != text.lower()]
    chunks = stage(docs, text, rest=others)
    found = joined(chunks)
    empty = found.where("n_shingles = 0").select("row", "chunk")
    first = F.min_by(F.struct("row", "chunk"), F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = empty.unionAll(found.where("n_shingles > 0").groupBy("group").agg(first.alias("f")).select("f.row", "f.chunk"))

    def keep(table: pa.Table, rows: pa.Table) -> pa.Table:
        if not (table.num_rows and rows.num_rows):
            return table.select(["text", "rest"]).slice(0, 0)
        return with_rows(table, rows.column("row").to_numpy()).select(["text", "rest"])

    # in place: only row numbers move, not the documents
    fields = [f for f in chunks.table.schema.fields if f.name in ("text", "rest")]
    out = chunks.table.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(keep, T.StructType(fields))
    place = {c: F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)}
    return out.select(*[place.get(c, F.col("text").alias(c)) for c in docs.columns])


def joined(chunks) -> DataFrame:
    """(row, chunk, doc_id, n_shingles, group, component_id) of each staged
    document; rows of one component share a group."""
    n1 = chunks.ranges(KEYS_A_BYTE)

    def ask(table: pa.Table) -> pa.Table:
        s = Shingles(table)
        keys, times = np.unique(counted(s.gram), return_counts=True)
        return requests(s.chunk, keys, n1, np.minimum(times, 255).astype(np.uint8), COUNT_BYTES)

    def post(table: pa.Table, replies: pa.Table) -> pa.Table:
        s = Shingles(table)
        keys = np.unique(counted(s.gram))
        rank = read_answers(replies, 1, keys, n1, bits=False)[np.searchsorted(keys, counted(s.gram))]
        order = np.lexsort((s.gram, rank, s.doc))
        nth = np.arange(len(order)) - np.repeat(np.cumsum(s.n) - s.n, s.n)
        n_short = s.n - (SIMILAR * s.n + 99) // 100 + 1
        chosen = order[(nth < np.repeat(n_short, s.n)) & (rank[order] > 1)]
        s1, s2 = s.signatures()
        n_post, n_doc = len(chosen), len(s.row)
        zeros = np.zeros(n_post, np.int64)
        return pa.table({
            "kind": pa.array(np.repeat([1, 0], [n_post, n_doc]), pa.int32()),
            "shingle": pa.array(np.concatenate([s.gram[chosen].view(np.int64), np.zeros(n_doc, np.int64)])),
            "row": pa.array(np.concatenate([s.row[s.doc[chosen]], s.row])), "chunk": pa.array(np.full(n_post + n_doc, s.chunk)),
            "doc_id": pa.concat_arrays([pa.nulls(n_post, pa.int64()), s.doc_id.combine_chunks()]),
            "n": pa.array(np.concatenate([zeros, s.n])), "s1": pa.array(np.concatenate([zeros, s1])), "s2": pa.array(np.concatenate([zeros, s2]))})

    counts = answers(chunks.map(ask, REQUEST), level, 1, bits=False, width=COUNT_BYTES)
    posted = staged(chunks.map_with(counts, post, POSTING), "shingle-lists")
    every = posted.where("kind = 0").select("row", "chunk", "doc_id", "n", "s1", "s2")
    # documents with the same set: the first row speaks for all
    same = staged(every.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("row", "chunk")).alias("f"), F.min("doc_id").alias("least"), F.min("n").alias("n"))
                  .select("s1", "s2", F.col("f.row").alias("first"), F.col("f.chunk").alias("chunk"), "least", "n"), "shingle-sets")
    lists = posted.where("kind = 1").select("shingle", "row").join(same.select(F.col("first").alias("row")), "row", "left_semi")
    lists = staged(lists, "shingle-lists-of-sets")
    heads = staged(lists.groupBy("shingle").agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle", "head"), "shingle-heads")
    near = components(lists.join(heads, "shingle").select(F.col("head").alias("a"), F.col("row").alias("b")))
    label = solved(chunks, staged(near.join(same.select(F.col("first").alias("node"), "chunk", "n"), "node"), "jaccard-near"))
    of = same.join(label, same["first"] == label["node"], "left").select("s1", "s2", "least", F.coalesce("label", "first").alias("label"))
    of = staged(of, "jaccard-labels")
    least = of.groupBy("label").agg(F.min("least").alias("component_id"))
    ids = staged(of.join(least, "label").select("s1", "s2", F.col("label").alias("group"), "component_id"), "jaccard-ids")
    found = every.where("n > 0").join(ids, ["s1", "s2"]).select("row", "chunk", "doc_id", F.col("n").alias("n_shingles"), "group", "component_id")
    return found.unionAll(every.where("n = 0").select("row", "chunk", "doc_id", F.col("n").alias("n_shingles"), F.col("row").alias("group"), F.col("doc_id").alias("component_id")))


def solved(chunks, near: DataFrame) -> DataFrame:
    """(node, label) of the documents linked within the (node, label, chunk, n)
    components of documents that share a short list."""
    sizes = staged(near.groupBy("label").agg(F.sum("n").alias("size")), "jaccard-sizes")
    total, most = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    groups = max(1, -(-total // BLOCK))
    blocks = F.ceil(F.col("size") / BLOCK)
    # small components share a group; a large one has blocks of its own
    grp = F.when(blocks > 1, -1 - F.col("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(groups)))
    blk = F.pmod(F.xxhash64("node"), blocks)
    placed = near.join(sizes, "label").select("node", "label", "chunk", "n", grp.alias("grp"), blk.alias("blk"), blocks.alias("blocks"))
    own = placed.select("chunk", "node", "grp", "blk", F.lit(0).cast("long").alias("oblk"), F.lit(1).alias("role"), F.col("node").alias("label"))
    if most <= BLOCK:
        return stars(staged(found(chunks, own), "jaccard-links"))
    large = placed.where("blocks > 1")
    hubs = hubs_of(large)
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    hubs = hubs.select("chunk", "node", "grp", every_block.alias("blk"), F.lit(0).cast("long").alias("oblk"), F.lit(1).alias("role"), F.col("node").alias("label"))
    links = staged(found(chunks, own.unionAll(hubs)), "jaccard-links")
    large = staged(large, "jaccard-placed")
    # of the large ones: all documents outside the largest group so far against all blocks
    so_far = staged(components(links), "jaccard-so-far")
    at = large.join(so_far.select("node", F.col("label").alias("now")), "node", "left").withColumn("now", F.coalesce("now", "node"))
    at = staged(at, "jaccard-large")
    counts = at.groupBy("grp", "now").agg(F.count(F.lit(1)).alias("n"))
    main = staged(counts.groupBy("grp").agg(F.max_by("now", F.struct("n", "now")).alias("main")), "jaccard-main")
    out = staged(at.join(main, "grp").where("now != main"), "jaccard-outside")
    n_out = staged(out.groupBy("grp").agg(F.ceil(F.sum("n") / BLOCK).alias("oblocks")), "jaccard-outside-sizes")
    asked = out.join(n_out, "grp").select("chunk", "node", "grp", every_block.alias("blk"), F.pmod(F.xxhash64("node", F.lit(1)), "oblocks").alias("oblk"), F.lit(1).alias("role"), F.col("now").alias("label"))
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("oblocks") - 1))
    there = at.join(n_out, "grp").select("chunk", "node", "grp", "blk", every_part.alias("oblk"), F.lit(0).alias("role"), F.col("now").alias("label"))
    every = links.unionAll(staged(found(chunks, asked.unionAll(there)), "jaccard-links-outside"))
    return components(every)


def stars(links: DataFrame) -> DataFrame:
    """Links that are final, to the least of each component, as labels."""
    label = links.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return label.unionAll(label.select(F.col("label").alias("node"), "label").distinct())


def hubs_of(large: DataFrame) -> DataFrame:
    """A few documents of each large component, by hash."""
    place = F.row_number().over(W.partitionBy("grp").orderBy(F.xxhash64("node", F.lit(2)), "node"))
    return large.withColumn("place", place).where(F.col("place") <= HUBS)


def found(chunks, wanted: DataFrame) -> DataFrame:
    """Solve groups of (chunk, node, grp, blk, oblk, role, label) documents."""

    def sets(table: pa.Table, wanted: pa.Table) -> pa.Table:
        if not (table.num_rows and wanted.num_rows):
            return pa.table({n: pa.array([], t) for n, t in zip(("grp", "blk", "oblk", "role", "row", "label", "shingles"), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))})
        s = Shingles(with_rows(table, wanted.column("node").to_numpy()))
        begin = np.cumsum(s.n) - s.n
        of = {int(r): s.gram[b:b + n].tobytes() for r, b, n in zip(s.row, begin, s.n)}
        return pa.table({"grp": wanted.column("grp"), "blk": wanted.column("blk"), "oblk": wanted.column("oblk"), "role": wanted.column("role"),
                         "row": wanted.column("node"), "label": wanted.column("label"),
                         "shingles": pa.array([of[r] for r in wanted.column("node").to_pylist()], pa.binary())})

    dealt = chunks.map_with(wanted, sets, SET)
    return dealt.groupBy("grp", "blk", "oblk").applyInArrow(solve, "a long, b long")


def with_rows(table: pa.Table, rows: np.ndarray) -> pa.Table:
    """The documents of a chunk that have some row numbers."""
    ord_ = table.column("ord").to_numpy()
    return table.filter(pa.array(np.isin(ord_, rows & ((1 << _BASE) - 1))))
