"""Documents in chunks, and a key exchange between chunks.

Operators that look for repeated strings need to know, for very many keys (64-
bit hashes), whether a key is found elsewhere. One row a key would be most of
the work, so keys travel packed:

* ``stage`` writes the documents once, bucketed by chunk, each chunk some MB of
  whole documents. Later steps read chunks in place: their text is not
  shuffled again.
* A step over the chunks yields requests: the chunk's distinct keys, packed and
  split into ranges of the key space (``requests``).
* ``answers`` gathers a range from all chunks and returns to each chunk one
  small number a key, packed in the order in which the chunk asked.

A key counts once a chunk, however often it occurs there, so the most frequent
string costs one entry a chunk: there are no hot keys. The number of ranges
follows the input, so that a range holds about ``RANGE_KEYS`` keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import ensure_checkpoint_dir

CHUNK_BYTES = 4 << 20
RANGE_KEYS = 1 << 20
BUCKET_BYTES = 24 << 20
BLOCK_BITS = 16
BLOCK = 1 << 15  # numbers worked on at a time, so that they stay in the cache

REQUEST = "part int, chunk long, keys binary, counts binary"
ANSWER = "chunk long, part int, round int, reply binary"


class Chunks:
    """The staged documents: ``table`` (chunk, ord, doc_id, text) and the
    number of bytes of text."""

    def __init__(self, table: DataFrame, n_bytes: int):
        self.table, self.n_bytes = table, n_bytes

    def ranges(self, keys_a_byte: float) -> int:
        return max(1, int(self.n_bytes * keys_a_byte / RANGE_KEYS) + 1)

    @property
    def texts(self) -> DataFrame:
        return self.table.select("chunk", "ord", "doc_id", "text")

    def map(self, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        return self.texts.groupBy("chunk").applyInArrow(fn, schema)

    def map_with(self, replies: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """Each chunk with the answers to it."""
        return self.texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(fn, schema)


def stage(docs: DataFrame, text: str = "text", chunk_bytes: int | None = None, rest: list[str] | None = None) -> Chunks:
    """Write (doc_id, text) in chunks: a chunk is closed when it holds
    ``chunk_bytes`` of text. Null texts become empty. The columns in ``rest``
    go with them as one struct. The catalog keeps no entry of the table; its
    files lie in the shared folder."""
    spark = docs.sparkSession
    chunk_bytes = chunk_bytes or CHUNK_BYTES
    more = [] if rest is None else [F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(rest)]).alias("rest")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, n = TaskContext.get().partitionId() << 33, 0, 0
        for b in batches:
            size = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
            out = np.zeros(len(size), np.int64)
            for i, s in enumerate(size):
                if held >= chunk_bytes:
                    chunk, held = chunk + 1, 0
                out[i] = chunk
                held += int(s) + 64
            yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(np.arange(n, n + len(size))), *b.columns], names=["chunk", "ord", *b.schema.names])
            n += len(size)

    given = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"), *more)
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ord", T.LongType()), *given.schema.fields])
    dealt = given.mapInArrow(deal, schema)
    total = given.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    name = f"chunks_{uuid.uuid4().hex}"
    # Spark refuses more buckets than this; chunks are grouped within a bucket, so it may hold more of them
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = max(1, min(most, -(-total // BUCKET_BYTES)))
    (dealt.write.format("parquet").option("compression", "zstd").option("path", f"{ensure_checkpoint_dir(spark)}/{name}")
     .bucketBy(buckets, "chunk").sortBy("chunk").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external one: its files stay, and with them the table just read
    return Chunks(table, total)


def ranges_met(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of the key space, of ``n`` alike ones, that sorted uint64 keys
    are in: their numbers, and where the keys of each begin and end. Takes a
    number of steps that depends on the keys, not on ``n`` (below 2 ** 32)."""
    low, high, by = keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32), np.uint64(n)
    part = ((high * by + ((low * by) >> np.uint64(32))) >> np.uint64(32)).astype(np.int64)   # keys * n / 2 ** 64
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(keys) else np.zeros(0, np.int64)
    return part[begin], begin, np.append(begin[1:], len(keys)) if len(keys) else begin


def requests(chunk: int, keys: np.ndarray, n: int, counts: np.ndarray | None = None, width: int = 8) -> pa.Table:
    """The chunk's distinct keys (sorted uint64), a row a range; with the
    number of its documents (uint8, at most 255) if the answer needs it. Only
    the highest ``width`` bytes are sent; the others have to be 0."""
    sent = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:]
    parts, begin, end = ranges_met(keys, n)
    return pa.table({
        "part": pa.array(parts, pa.int32()), "chunk": pa.array(np.full(len(parts), chunk), pa.int64()),
        "keys": pa.array([sent[b:e].tobytes() for b, e in zip(begin, end)], pa.binary()),
        "counts": pa.array([None if counts is None else counts[b:e].tobytes() for b, e in zip(begin, end)], pa.binary())})


def answers(asked: DataFrame, judge: Callable[[np.ndarray, np.ndarray | None], np.ndarray], round_: int, bits: bool,
            width: int = 8) -> DataFrame:
    """For each request an answer: ``judge`` gets the number of chunks that
    hold each distinct key of a range, and the sum of their counts."""

    def gather(table: pa.Table) -> pa.Table:
        chunks, part = table.column("chunk").to_pylist(), table.column("part")[0].as_py()
        blobs = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, width) for x in table.column("keys")]
        sizes = [len(b) for b in blobs]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, 8 - width:] = np.concatenate(blobs)
        keys = wide.view("<u8")[:, 0]
        order = np.argsort(keys, kind="stable")
        same = keys[order]
        begin = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
        n = np.diff(np.concatenate([begin, [len(same)]]))
        total = None
        if table.column("counts")[0].is_valid:
            counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("counts")])
            total = np.add.reduceat(counts[order].astype(np.int64), begin)
        found = judge(n, total)
        reply = np.empty(len(keys), found.dtype)
        reply[order] = np.repeat(found, n)
        ends = np.cumsum(sizes)
        out = [reply[e - s:e] for s, e in zip(sizes, ends)]
        return pa.table({
            "chunk": pa.array(chunks, pa.int64()), "part": pa.array([part] * len(chunks), pa.int32()),
            "round": pa.array([round_] * len(chunks), pa.int32()),
            "reply": pa.array([(np.packbits(o) if bits else o).tobytes() for o in out], pa.binary())})

    return asked.groupBy("part").applyInArrow(gather, ANSWER)


def read_answers(replies: pa.Table, round_: int, keys: np.ndarray, n: int, bits: bool) -> np.ndarray:
    """The answers of a round, in the order of the chunk's keys."""
    parts, begin, end = ranges_met(keys, n)
    out = np.zeros(len(keys), bool if bits else np.uint8)
    mine = replies.filter(pc.equal(replies.column("round"), round_))
    for i, blob in zip(np.searchsorted(parts, mine.column("part").to_numpy()), mine.column("reply")):
        got = np.frombuffer(blob.as_py(), np.uint8)
        out[begin[i]:end[i]] = np.unpackbits(got, count=end[i] - begin[i]) if bits else got
    return out


# ---- hashes over whole arrays

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number well scattered over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def grams(x: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive (well scattered) numbers, by doubling."""
    n = len(x) - k + 1
    out = np.empty(max(0, n), np.uint64)
    for at in range(0, n, BLOCK):
        out[at:at + BLOCK] = _grams(x[at:at + BLOCK + k - 1], k)
    return out


def _grams(x: np.ndarray, k: int) -> np.ndarray:
    n, out, at, size, left, power = len(x) - k + 1, None, 0, 1, k, int(_A)
    while True:
        if left & 1:
            out = x[at:at + n] if out is None else out * np.uint64(power) + x[at:at + n]
            at += size
        left >>= 1
        if not left:
            return mixed(out)
        x = x[:-size] * np.uint64(power) + x[size:]
        power, size = power * power % (1 << 64), size * 2


def least_in_windows(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of w numbers the place of the least (leftmost) one."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << BLOCK_BITS) - 1)
    out = np.empty(n, np.int64)
    for at in range(0, n, BLOCK):
        part = h[at:min(len(h), at + BLOCK + w - 1)]
        v = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while 2 * size <= w:
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < w:
            v = np.minimum(v[:len(part) - w + 1], v[w - size:w - size + len(part) - w + 1])
        out[at:at + BLOCK] = (v & low).astype(np.int64) + at
    return out


class Text:
    """The documents of a chunk end to end, each followed by a line end."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("ord")
        texts = [x.as_py().encode("utf-8", "surrogatepass") for x in table.column("text")]
        self.chunk = table.column("chunk")[0].as_py()
        self.doc_id = table.column("doc_id")
        self.size = np.array([len(x) for x in texts], np.int64)
        self.end = np.cumsum(self.size + 1) - 1
        self.begin = self.end - self.size
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)


def distinct(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, which of them each place has, and how many places
    have it."""
    found, which, n = np.unique(keys[places], return_inverse=True, return_counts=True)
    return found, which, n
