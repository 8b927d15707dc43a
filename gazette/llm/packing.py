"""Best-fit packing: tokenise documents and pack them into full sequences.

Each task packs its own documents as they come, by bounded-space best-fit: a
fixed number of bins is open at a time, held in a bitset keyed by free space.
A piece goes to the open bin that it fills best, found with two bit operations;
if none has room a new bin opens, and if too many are open the fullest closes.
When a task ends, its open bins are left over. They, not their documents, are
packed once more, in groups of a bounded number of tasks, so that a sequence is
only left part-filled once a group and not once a task.

Documents never move: tokens are counted where the text is read. What moves is
a row an open bin, at most ``OPEN_BINS`` a task. Pieces are written to the
shared folder first, so a lost executor can't deal them to other bins.

A text is tokenised as its parts between spaces and line ends; the tokenizer
drops white space and never joins over it, so the ids are those of the whole
text (tested). Each worker keeps the ids of parts it has seen, up to a bound.

Defined cases: a null or empty text is one piece with the end token alone.
Repeated rows, and null doc_ids, are documents of their own. An empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import staged

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 512
TASKS_A_GROUP = 64
# Latin letters, then punctuation that the tokenizer parts from them.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-Þß-öø-ÿ]+)([.,!?;:#$%&*()\"]*)")
MAX_KNOWN = 1_200_000  # parts whose ids a worker keeps

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, place long"
LEFT = "bin long, used long"


class PartTokenizer:
    """Token ids of texts (as little-endian unsigned 32-bit numbers), by the
    parts between blanks that are seen again and again."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        # how the model is shown letters beyond ASCII
        shown = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.shown = {ord(c): shown(c)[0][0] for c in "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"}

    def whole(self, part: str) -> bytes:
        return ids_bytes(self.tokenizer.encode(part, add_special_tokens=False).ids)

    def learn(self, part: str) -> bytes:
        """A plain word with punctuation after it is put together from the ids
        of the lower-cased letters, which the model gets as they are, and of
        the punctuation; everything else goes through the whole tokenizer."""
        known = self.known
        if len(known) > MAX_KNOWN:
            known.clear()
        plain = PLAIN.fullmatch(part)
        if not plain:
            ids = self.whole(part)
        else:
            letters, tail = plain[1].lower(), plain[2]
            ids = known.get(letters)
            if ids is None:
                ids = ids_bytes([t.id for t in self.tokenizer.model.tokenize(letters.translate(self.shown))])
                known[letters] = ids
            if tail:
                if tail not in known:
                    known[tail] = self.whole(tail)
                ids = ids + known[tail]
        known[part] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        parts = (text or "").replace("\n", " ").split(" ")
        known, learn = self.known, self.learn
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            return b"".join([known[p] if p in known else learn(p) for p in parts])


def ids_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=2)
def tokenizer_for(path: str) -> PartTokenizer:
    return PartTokenizer(path)


class OpenBins:
    """Bounded-space best-fit. Bins are numbered from ``first``."""

    def __init__(self, capacity: int, most_open: int, first: int = 0):
        self.capacity, self.most_open, self.next = capacity, most_open, first
        self.free: dict[int, list[int]] = {}  # free space -> open bins
        self.bits = 0                         # bit f: a bin with f free is open
        self.n_open = 0

    def _take(self, free: int) -> int:
        bins = self.free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset in it) of a piece of ``size`` <= capacity."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.next
            self.next += 1
        left = free - size
        if left:
            self.free.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.n_open += 1
            if self.n_open > self.most_open:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
        return number, self.capacity - free

    def left(self) -> list[tuple[int, int]]:
        """(bin, used) of the open bins."""
        return [(b, self.capacity - f) for f, bins in self.free.items() for b in bins]


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, open_bins: int = OPEN_BINS) -> DataFrame:
    """A row a piece with its bin and place there; and, with a null piece, a row
    for each bin that was open when its task ended (length: the space used)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_for(tokenizer)
        bins = OpenBins(capacity, open_bins, TaskContext.get().partitionId() << 33)
        end, step = ids_bytes([end_id]), 4 * capacity
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "place"]
        types = [pa.int64(), pa.int32()] + [pa.int64()] * 5

        def batch(rows):
            cols = list(zip(*rows)) if rows else [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            rows = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = tok.encode(t.as_py()) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), *bins.put(len(part) // 4)))
            yield batch(rows)
        yield batch([(None, None, None, used, None, number, None) for number, used in bins.left()])

    return docs.select("doc_id", text).mapInArrow(pack, PIECE)


def merged(left: DataFrame, capacity: int = CAPACITY, tasks_a_group: int = TASKS_A_GROUP) -> DataFrame:
    """(bin, used) of left-over bins -> (bin, sequence, base): the bins of a
    group of tasks packed together, the fullest first."""

    def again(table: pa.Table) -> pa.Table:
        number = table.column("bin").to_numpy()
        used = table.column("used").to_numpy()
        bins, host, out = OpenBins(capacity, len(used) + 1), {}, []
        for i in np.lexsort((number, -used)):
            b, base = bins.put(int(used[i]))
            out.append((int(number[i]), host.setdefault(b, int(number[i])), base))
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=["bin", "sequence", "base"])

    group = F.floor(F.shiftright("bin", 33) / tasks_a_group)
    return (left.withColumn("g", group).groupBy("g")
            .applyInArrow(again, "bin long, sequence long, base long"))


def best_fit_pack(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """A row a piece of ``docs``: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset."""
    rows = staged(pieces(docs, tokenizer, text, capacity), "pack-pieces")
    left = rows.where(F.col("piece").isNull()).select(F.col("bin"), F.col("length").alias("used"))
    moved = merged(left, capacity).withColumnRenamed("bin", "of")
    kept = rows.where(F.col("piece").isNotNull())
    return kept.join(moved, kept["bin"] == moved["of"], "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("sequence", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("base", F.lit(0))).alias("offset"))
