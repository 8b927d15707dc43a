"""Ranked lexical search by presence masks.

A set of items (queries) is ranked against all documents. Documents come in
chunks; in a chunk each term of the items has a bitmap of the documents that hold
it. For an item, the documents of a chunk are grouped by *presence mask*, the set
of the item's terms that they hold: starting from all documents with any of the
terms, a group is split in two by a term's bitmap (``and``, ``and not``), the
term that can add most first. A group's maximum score is what the terms that are
in its mask, or may still be, can add at most in the chunk. The group of highest
maximum is always taken next: it is split on, or, once its mask is known, its
documents are scored. The item is done when the highest maximum left is below
the k-th best score found so far; the best scores of earlier chunks of the task
count, so most groups are never split to the end.

Two passes. The first tokenises every text once and writes, a row a document,
the items' terms it holds with their counts, and its length; the second reads
these rows. Between them the number of documents, their terms and each term's
document frequency are summed by Spark. Each task gives at most k rows an item;
the best k of them are the result.

Items are read in blocks of ``BLOCK_ITEMS`` or so (by hash), each with its two passes
and broadcasts of bounded size (the block's vocabulary and terms); every item
meets every document.

Scores are whole numbers: a term weighs floor(1000 ln((2N+2) / (2df+1))), and
adds its weight times (10^9 tf) div (1000 tf + 8 m) for each time the item has
it, where m = 25 + (75 n N) div L for a document of n terms.

Defined cases: null and empty texts, and those without a term, are no documents
and no items; every row of the items is an item of its own, so rows alike get
results alike; repeated documents are ranked each; equal scores go by ascending
doc_id, null last. Without documents or items the result is empty. Extra columns
don't matter.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import staged

K = 10
CHUNK = 2048          # documents whose bitmaps are made together
BLOCK_ITEMS = 2000    # items searched in one pass
PIECE = 1 << 20       # bytes tokenised at a time
FEW = 8               # documents of a group that are no more split by bitmaps
PART = 25
WHOLE = 100

# every byte that is neither an ASCII letter or digit nor part of another character
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_TABLE = bytes(32 if c in _SEPARATORS else c for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time: runs of letters, digits and
    non-ASCII characters, A-Z lower-cased, as UTF-8."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().translate(_TABLE)  # bytes.lower maps A-Z alone
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: int, n_docs: int, n_terms: int) -> int:
    return PART + (WHOLE - PART) * n * n_docs // n_terms


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item_id, number, terms, times) of the items that have a term."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for t in b.column("text").to_pylist():
                c = Counter()
                for piece in terms(t):
                    c.update(piece)
                found.append(sorted(c.items()))
            yield pa.RecordBatch.from_arrays([
                b.column("item_id"), b.column("number"), pa.array([[t for t, _ in f] for f in found], pa.list_(pa.binary())),
                pa.array([[n for _, n in f] for f in found], pa.list_(pa.int64()))], names=["item_id", "number", "terms", "times"])

    given = items.select(items[item].alias("item_id"), F.monotonically_increasing_id().alias("number"), items[text].alias("text"))
    kind = given.schema["item_id"].dataType.simpleString()
    return given.mapInArrow(cut, f"item_id {kind}, number long, terms array<binary>, times array<long>").where(F.size("terms") > 0)


def postings(docs: DataFrame, vocabulary: list[bytes], doc: str, text: str) -> DataFrame:
    """(doc_id, n, at, tf): a document's number of terms, which of the sorted
    vocabulary it holds (packed int32) and how often (packed int32)."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            n, at, tf = [], [], []
            for t in b.column("text"):
                found, size = Counter(), 0
                for piece in terms(t.as_py()):
                    size += len(piece)
                    found.update(piece)
                mine = sorted((known[w], c) for w, c in found.items() if w in known)
                n.append(size)
                at.append(np.array([i for i, _ in mine], "<i4").tobytes())
                tf.append(np.array([c for _, c in mine], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(at, pa.binary()), pa.array(tf, pa.binary())],
                                             names=["doc_id", "n", "at", "tf"])

    given = docs.select(docs[doc].alias("doc_id"), docs[text].alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(count, f"doc_id {kind}, n long, at binary, tf binary").where("n > 0")


def frequencies(rows: DataFrame, size: int) -> dict[int, int]:
    """Documents a term of the vocabulary: one array a task, added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column("at"):
                total[np.frombuffer(x.as_py(), "<i4")] += 1  # a document has a term once
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["term", "df"])

    summed = rows.select("at").mapInArrow(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in summed.collect()}  # no more rows than the vocabulary has


class Chunk:
    """Documents of a chunk: for each term a bitmap of the documents that hold
    it, what it adds to each of them, and the most it adds to any."""

    def __init__(self, doc_ids: list, holds: list[np.ndarray], times: list[np.ndarray], m: list[int], weights: np.ndarray):
        self.doc_ids = doc_ids
        counts = [len(x) for x in holds]
        at = np.concatenate([*holds, np.zeros(0, "<i4")]).astype(np.int64)
        tf = np.concatenate([*times, np.zeros(0, "<i4")]).astype(np.int64)
        doc = np.repeat(np.arange(len(doc_ids)), counts)
        self.adds = weights[at] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(np.array(m, np.int64), counts)))
        order = np.argsort(at, kind="stable")
        self.doc, self.adds, at = doc[order], self.adds[order], at[order]
        begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, int)
        self.place = {int(at[b]): (int(b), int(e)) for b, e in zip(begin, np.append(begin[1:], len(at)))}
        self.bitmaps: dict[int, int] = {}

    def bitmap(self, term: int) -> int:
        """The documents with a term, as the bits of a number."""
        if term not in self.bitmaps:
            b, e = self.place[term]
            bits = np.zeros(len(self.doc_ids), np.uint8)
            bits[self.doc[b:e]] = 1
            self.bitmaps[term] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        return self.bitmaps[term]

    def members(self, group: int) -> np.ndarray:
        data = np.frombuffer(group.to_bytes(-(-len(self.doc_ids) // 8), "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(data, bitorder="little"))

    def column(self, term: int, times: int) -> tuple[np.ndarray, np.ndarray]:
        b, e = self.place[term]
        return self.doc[b:e], self.adds[b:e] * times


class Best:
    """The k best documents of an item so far, the worst of them first."""

    def __init__(self, k: int):
        self.k, self.heap, self.n = k, [], 0

    @property
    def least(self) -> int:
        """The score that a document has to reach."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, score: int, doc_id) -> None:
        low = float("inf") if doc_id is None else doc_id
        self.n += 1
        entry = (score, -low, -self.n, doc_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


def search(chunk: Chunk, item: list[tuple[int, int]], best: Best) -> int:
    """Offers all documents of the chunk that could be among the best of an item,
    given as (term, times). Returns the number of distinct masks evaluated."""
    held = [(t, *chunk.column(t, n)) for t, n in item if t in chunk.place]
    held = sorted(((int(adds.max()), t, doc, adds) for t, doc, adds in held), key=lambda x: (-x[0], x[1]))
    held = [x for x in held if x[0] > 0]
    most = [x[0] for x in held]
    left = [0] * (len(held) + 1)  # what the terms from here on can add
    for i in reversed(range(len(held))):
        left[i] = left[i + 1] + most[i]
    if left[0] < best.least:
        return 0
    maps = [chunk.bitmap(t) for _, t, _, _ in held]
    everything = functools.reduce(int.__or__, maps, 0)
    # (-maximum, tie, terms decided, most the mask's terms add, mask, documents)
    queue, tie, evaluated = [(-left[0], 0, 0, 0, 0, everything)], 0, 0
    while queue and -queue[0][0] >= best.least:
        _, _, depth, sure, mask, group = heapq.heappop(queue)
        if depth == len(held):
            evaluated += 1
            members = chunk.members(group)
            score = np.zeros(len(members), np.int64)
            for j, (_, _, doc, adds) in enumerate(held):
                if mask >> j & 1:
                    score += adds[np.searchsorted(doc, members)]
            for i, x in zip(members, score):
                best.offer(int(x), chunk.doc_ids[i])
            continue
        if group.bit_count() <= FEW:
            parts = whole_masks(maps, most, depth, sure, mask, group)
        else:
            yes = group & maps[depth]
            parts = [(depth + 1, sure + most[depth], mask | 1 << depth, yes), (depth + 1, sure, mask, group ^ yes)]
        for d, add, key, docs in parts:
            if docs and add + left[d] >= best.least:
                tie += 1
                heapq.heappush(queue, (-add - left[d], tie, d, add, key, docs))
    return evaluated


def whole_masks(maps: list[int], most: list[int], depth: int, sure: int, mask: int, group: int) -> list[tuple[int, int, int, int]]:
    """A small group by its documents' whole masks, which are read a document at
    a time: (terms decided, most they add, mask, documents)."""
    found: dict[int, int] = {}
    while group:
        one = group & -group
        group ^= one
        key = mask
        for j in range(depth, len(maps)):
            if maps[j] & one:
                key |= 1 << j
        found[key] = found.get(key, 0) | one
    return [(len(maps), sure + sum(most[j] for j in range(depth, len(maps)) if key >> j & 1), key, docs) for key, docs in found.items()]


def searched(rows: DataFrame, block: list[tuple[int, list[tuple[int, int]]]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's k best documents (number, doc_id, score) of each item of a
    block, which is a list of (number, [(term, times)])."""
    shared = rows.sparkSession.sparkContext.broadcast((block, weights))
    kind = rows.schema["doc_id"].dataType

    def search_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w = shared.value
        best = [Best(k) for _ in items]
        for b in batches:
            for first in range(0, b.num_rows, CHUNK):
                c = b.slice(first, CHUNK)
                chunk = Chunk(c.column("doc_id").to_pylist(), [np.frombuffer(x.as_py(), "<i4") for x in c.column("at")],
                              [np.frombuffer(x.as_py(), "<i4") for x in c.column("tf")],
                              [length_part(n, n_docs, n_terms) for n in c.column("n").to_pylist()], w)
                for (_, item), found in zip(items, best):
                    search(chunk, item, found)
        out = [(number, d, s) for (number, _), found in zip(items, best) for s, _, _, d in found.heap]
        numbers, docs, scores = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(docs, to_arrow_type(kind)), pa.array(scores, pa.int64())],
                                         names=["number", "doc_id", "score"])

    return rows.mapInArrow(search_task, f"number long, doc_id {kind.simpleString()}, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = K, doc: str = "doc_id", item: str = "item_id", text: str = "text",
         block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    known = staged(item_terms(items, item, text), "lexical-items")
    blocks = max(1, -(-known.count() // block_items))
    out = None
    for i in range(blocks):
        mine = known.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == i).select("number", "terms", "times").orderBy("number").collect()
        vocabulary = sorted({t for r in mine for t in r["terms"]})
        at = {bytes(t): n for n, t in enumerate(vocabulary)}
        rows = staged(postings(docs, [bytes(t) for t in vocabulary], doc, text), "lexical-postings")
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        n_docs, n_terms = total["n"], total["l"] or 0
        df = frequencies(rows, len(vocabulary))
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
        block = [(r["number"], [(at[bytes(t)], n) for t, n in zip(r["terms"], r["times"])]) for r in mine]
        some = searched(rows, block, weights, n_docs, n_terms, k)
        out = some if out is None else out.unionByName(some)
    order = W.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return known.select("item_id", "number").join(top, "number").select("item_id", "rank", "doc_id", "score")
