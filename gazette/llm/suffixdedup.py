"""Suffix-array dedup: bytes covered by 50-byte strings of earlier documents go.

A suffix array of every byte would be fifty times the corpus, so only suffixes
that matter are sorted. A string of 50 bytes always holds its anchor, the
20-byte gram of least hash, which equal strings choose at the same place.

1. Each chunk of documents asks which of its anchors another chunk holds, too.
   What starts at an anchor met once only can't be repeated.
2. The suffixes at the other anchors, with the bytes to their left that a
   string holding the anchor can reach, are range-partitioned by their leading
   eight bytes; the splitters come from a sample. A range sorts its suffixes by
   multikey quicksort, eight bytes at a time and only among equals, and so the
   reversed bytes to the left. Common prefixes of neighbours then say which
   suffixes share k bytes, for any k: strings of 50 bytes around an anchor are
   equal if they share o bytes to its left and 50 - o from it on. For each o the
   least doc_id of each class of equal strings tells which strings an earlier
   document holds.
3. A leading token so frequent that several splitters fall on it would be one
   range for all of its suffixes. It is dealt to all ranges between these
   splitters by document instead; there the classes of its strings, a row a
   class, are compared across the ranges' boundaries by their hash.

In a chunk alike surroundings of an anchor are sent once, for the least doc_id.
Anchors and boundary classes are compared by 64-bit hashes, ranges by bytes.

Defined cases: a null or empty text has no bytes. Texts under 50 bytes lose
nothing. Rows of one doc_id don't take bytes from each other; a null doc_id is
smaller than all others. Repeated rows fare alike. Extra columns are not read;
an empty table gives an empty result. Bytes are cut without regard to
characters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chunks import REQUEST, Text, answers, distinct, grams, least_in_windows, mixed, read_answers, requests, stage
from ..operators.ordering import global_rank
from .common import staged

WINDOW = 50
SEED = 20
REACH = WINDOW - SEED        # bytes to the left of an anchor that a string can hold
KEYS_A_BYTE = 0.06           # anchors; sets the number of ranges in step 1
SUFFIXES_A_RANGE = 100_000
SUFFIXES_A_BYTE = 0.012      # about so many are sorted
SAMPLE_CHUNKS = 16           # one chunk of so many is read for splitters, so many at least
SAMPLE_A_RANGE = 64          # suffixes sampled for each range that is to be
LEFT, RIGHT = 32, 56         # bytes kept of each side, in whole words of eight
NO_ID = np.iinfo(np.int64).min

_SCATTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

RECORDS = "part int, chunk long, docs binary, spans binary, sides binary"
MARKS = "chunk long, part int, round int, reply binary"


class Suffixes:
    """A chunk's strings of 50 bytes and the anchor of each."""

    def __init__(self, table: pa.Table):
        self.text = t = Text(table)
        count = np.maximum(0, t.size - WINDOW + 1)
        self.start = np.repeat(t.begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        self.gram = grams(_SCATTER[t.data], SEED)
        least = least_in_windows(self.gram, WINDOW - SEED + 1)
        anchor = least[self.start]
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
        self.anchor = anchor[new]
        last = np.concatenate([new[1:], [len(anchor)]])[:len(new)] - 1
        # a string holding the anchor starts from ``far`` to ``near`` bytes before it
        self.far = (self.anchor - self.start[new]).astype(np.uint8)
        self.near = (self.anchor - self.start[last]).astype(np.uint8)
        ids = t.doc_id.fill_null(int(NO_ID)).to_numpy()
        self.doc = ids[np.searchsorted(t.begin, self.anchor, "right") - 1] if len(ids) else np.zeros(0, np.int64)
        self.keys, self.which, self.times = distinct(self.gram, self.anchor)

    def met_again(self, replies: pa.Table, n: int) -> "Records":
        met = read_answers(replies, 1, self.keys, n, bits=True) | (self.times > 1)
        return Records(self, np.flatnonzero(met[self.which]))


class Records:
    """The suffixes of some anchors, with what is to their left. ``sides`` has
    the bytes to the left, the nearest first, then the suffix; bytes that no
    string around the anchor holds are 0."""

    def __init__(self, s: Suffixes, chosen: np.ndarray):
        self.anchor, self.far, self.near, self.doc = s.anchor[chosen], s.far[chosen], s.near[chosen], s.doc[chosen]
        data = np.concatenate([np.zeros(LEFT, np.uint8), s.text.data, np.zeros(RIGHT, np.uint8)])
        step = np.concatenate([-1 - np.arange(LEFT), np.arange(RIGHT)])
        sides = data[(self.anchor + LEFT)[:, None] + step]
        far, length = self.far.astype(np.int64), WINDOW - self.near.astype(np.int64)
        sides[:, :LEFT][np.arange(LEFT) >= far[:, None]] = 0
        sides[:, LEFT:][np.arange(RIGHT) >= length[:, None]] = 0
        self.sides = sides
        self.lead = sides[:, LEFT:LEFT + 8].copy().view(">u8").astype(np.uint64)[:, 0]
        # alike surroundings: the one of the least document speaks for all
        words = sides.view(np.uint64).reshape(len(sides), -1)
        key = (far.astype(np.uint64) << np.uint64(8)) | self.near
        for j in range(words.shape[1]):
            key = mixed(key ^ words[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort((self.doc, key))
        same = key[order]
        new = np.concatenate([[True], same[1:] != same[:-1]]) if len(order) else np.zeros(0, bool)
        self.speaker = np.empty(len(order), np.int64)
        self.speaker[order] = order[new][np.cumsum(new) - 1]
        self.speaks = self.speaker == np.arange(len(order))

    def parts(self, splitters: np.ndarray) -> np.ndarray:
        """The range of each suffix; one whose token several splitters fall on
        goes to one of the ranges between them."""
        low, high = np.searchsorted(splitters, self.lead, "left"), np.searchsorted(splitters, self.lead, "right")
        spread = np.maximum(1, high - low)
        pick = (mixed(self.doc.astype(np.uint64)) % spread.astype(np.uint64)).astype(np.int64)
        return np.where(high - low > 1, low + 1 + np.minimum(pick, high - low - 1), high)

    def sent(self, splitters: np.ndarray):
        """(range, record numbers) of what is sent, in order."""
        part = self.parts(splitters)
        own = np.flatnonzero(self.speaks)
        own = own[np.argsort(part[own], kind="stable")]
        cut = np.flatnonzero(np.diff(part[own])) + 1
        return [(int(part[i[0]]), i) for i in np.split(own, cut) if len(i)]


def sort_suffixes(words: np.ndarray) -> np.ndarray:
    """Multikey quicksort: order rows by the first word, then each run of equal
    ones, and only those, by the next."""
    order = np.argsort(words[:, 0], kind="stable")
    run = np.concatenate([[0], np.cumsum(words[order[1:], 0] != words[order[:-1], 0])])
    for j in range(1, words.shape[1]):
        size = np.bincount(run)
        open_ = np.flatnonzero(size[run] > 1)
        if not len(open_):
            break
        rows = order[open_]
        by = np.lexsort((words[rows, j], run[open_]))
        order[open_] = rows[by]
        new = np.concatenate([[False], run[1:] != run[:-1]])
        new[1:] |= words[order[1:], j] != words[order[:-1], j]
        # runs that were told apart before stay so
        run = np.cumsum(new)
    return order


def common_prefix(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row of the order shares with the one before it."""
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for j in range(words.shape[1]):
        differ = words[order[alive], j] ^ words[order[alive - 1], j]
        same = differ == 0
        out[alive[same]] += 8
        at, d = alive[~same], differ[~same]
        zeros = np.zeros(len(d), np.int64)
        for k in range(1, 8):
            zeros += (d >> np.uint64(64 - 8 * k)) == 0
        out[at] += zeros
        alive = alive[same]
    return out


def shared_ids(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the common prefix of each with the one before."""
    order = sort_suffixes(words)
    return order, common_prefix(words, order)


def classes(sides: np.ndarray, far: np.ndarray, near: np.ndarray):
    """For each o that a string can start before its anchor: the rows with such
    a string and the class of equal strings that each is in."""
    left = sides[:, :LEFT].copy().view(">u8").astype(np.uint64)
    right = sides[:, LEFT:].copy().view(">u8").astype(np.uint64)
    (lo, lcp_l), (ro, lcp_r) = shared_ids(left), shared_ids(right)
    n = len(sides)
    lid, rid = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(REACH + 1):
        rows = np.flatnonzero((near <= o) & (o <= far))
        if not len(rows):
            continue
        lid[lo] = np.cumsum(lcp_l < o)
        rid[ro] = np.cumsum(lcp_r < WINDOW - o)
        yield o, rows, rid[rows] * (n + 1) + lid[rows]


def earliest(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The least document of each row's group."""
    order = np.argsort(group, kind="stable")
    same = group[order]
    begin = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    out = np.empty(len(doc), doc.dtype)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], begin), np.diff(np.concatenate([begin, [len(same)]])))
    return out


def sample_splitters(chunks, first: DataFrame, n1: int, n: int) -> np.ndarray:
    """``n - 1`` leading tokens that part the suffixes evenly, from a share of
    the chunks and, by hash, of their suffixes: the sample grows with the number
    of ranges. It is ranked in Spark; the driver gets the splitters."""
    of = chunks.table.select("chunk").distinct()
    share = max(1.0 / SAMPLE_CHUNKS, min(1.0, SAMPLE_CHUNKS / max(1, of.count())))
    taken = F.pmod(F.xxhash64("chunk"), F.lit(1 << 30)) / float(1 << 30) < share
    rate = np.uint64(min(1.0, SAMPLE_A_RANGE / (SUFFIXES_A_RANGE * share)) * (2 ** 64 - 2048))

    def leads(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"lead": pa.array([], pa.int64())})
        r = Suffixes(table).met_again(replies, n1)
        lead, doc = r.lead[r.speaks], r.doc[r.speaks].astype(np.uint64)
        # by document and place among its suffixes of this lead: frequent leads count as often as they are met
        lead = lead[mixed(lead ^ mixed(doc + np.arange(len(doc), dtype=np.uint64))) <= rate]
        return pa.table({"lead": pa.array((lead ^ np.uint64(1 << 63)).view(np.int64))})   # signed, in the same order

    sampled = chunks.texts.where(taken).groupBy("chunk").cogroup(first.where(taken).groupBy("chunk")).applyInArrow(leads, "lead long")
    ranked = global_rank(sampled, ["lead"])
    size = ranked.count()
    if not size:
        return np.zeros(0, np.uint64)
    step = F.expr(f"(rank * {n} div {size}) > ((rank - 1) * {n} div {size})")   # the last of each n-th part
    picked = ranked.where(step & (F.col("rank") < size)).select("rank", "lead").orderBy("rank").toPandas()
    cuts = picked["lead"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    # a sample smaller than the ranges gives a splitter several of them
    parts = np.diff(np.concatenate([[0], picked["rank"].to_numpy() * n // size]))
    return np.repeat(cuts, parts)


def suffix_dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of
    every row of ``docs``, and the hash of kept."""
    chunks = stage(docs, text)
    n1, n2 = chunks.ranges(KEYS_A_BYTE), max(1, int(chunks.n_bytes * SUFFIXES_A_BYTE / SUFFIXES_A_RANGE) + 1)

    def ask(table: pa.Table) -> pa.Table:
        s = Suffixes(table)
        return requests(s.text.chunk, s.keys, n1)

    first = staged(answers(chunks.map(ask, REQUEST), lambda n, _: n > 1, 1, bits=True), "anchors-met")
    splitters = sample_splitters(chunks, first, n1, n2)
    hot = np.unique(splitters[1:][splitters[1:] == splitters[:-1]])

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        s = Suffixes(table)
        r = s.met_again(replies, n1)
        rows = [(p, s.text.chunk, r.doc[i].tobytes(), np.stack([r.far[i], r.near[i]]).tobytes(), r.sides[i].tobytes()) for p, i in r.sent(splitters)]
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["part", "chunk", "docs", "spans", "sides"])

    def unpacked(table: pa.Table):
        doc = [np.frombuffer(x.as_py(), np.int64) for x in table.column("docs")]
        sizes = np.array([len(d) for d in doc])
        spans = np.concatenate([np.frombuffer(x.as_py(), np.uint8).reshape(2, -1) for x in table.column("spans")], axis=1)
        sides = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("sides")]).reshape(-1, LEFT + RIGHT)
        return np.concatenate(doc), sizes, spans[0].astype(np.int64), spans[1].astype(np.int64), sides

    def compare(table: pa.Table) -> pa.Table:
        doc, sizes, far, near, sides = unpacked(table)
        most, least = np.full(len(doc), 255, np.uint8), np.full(len(doc), 255, np.uint8)
        for o, rows, group in classes(sides, far, near):
            hit = rows[doc[rows] > earliest(group, doc[rows])]
            most[hit] = o
            least[hit[least[hit] == 255]] = o
        ends = np.cumsum(sizes)
        return pa.table({
            "chunk": table.column("chunk"), "part": table.column("part"), "round": pa.array([2] * len(sizes), pa.int32()),
            "reply": pa.array([np.stack([most[e - z:e], least[e - z:e]]).tobytes() for z, e in zip(sizes, ends)], pa.binary())})

    def boundary(table: pa.Table) -> pa.Table:
        """The strings of too frequent tokens: a row a string, with its record."""
        out = ([], [], [], [], [], [])
        doc, sizes, far, near, sides = unpacked(table)
        lead = sides[:, LEFT:LEFT + 8].copy().view(">u8").astype(np.uint64)[:, 0]
        of = np.repeat(np.arange(len(sizes)), sizes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        frequent = np.isin(lead, hot)
        chunk, part = table.column("chunk").to_numpy(), table.column("part").to_numpy()
        for o in range(REACH + 1):
            rows = np.flatnonzero(frequent & (near <= o) & (o <= far))
            key = np.full(len(rows), o, np.uint64)
            string = np.concatenate([sides[rows][:, :o][:, ::-1], sides[rows][:, LEFT:LEFT + WINDOW - o], np.zeros((len(rows), 6), np.uint8)], axis=1)
            for w in np.ascontiguousarray(string).view(np.uint64).T:
                key = mixed(key ^ w) * np.uint64(0x9E3779B97F4A7C15)
            for c, v in zip(out, (key.view(np.int64), doc[rows], chunk[of[rows]], part[of[rows]], nth[rows], np.full(len(rows), o))):
                c.append(v)
        names = ["key", "doc", "chunk", "part", "nth", "o"]
        return pa.table({n: pa.array(np.concatenate(c) if c else [], pa.int64()) for n, c in zip(names, out)})

    def pack(table: pa.Table) -> pa.Table:
        """What the boundaries found, as one reply a chunk and range."""
        cols = np.stack([table.column(n).to_numpy() for n in ("nth", "most", "least")]).astype(np.int32)
        return pa.table({"chunk": table.column("chunk")[:1], "part": table.column("part")[:1].cast(pa.int32()), "round": pa.array([3], pa.int32()), "reply": pa.array([cols.tobytes()], pa.binary())})

    sent = chunks.map_with(first, send, RECORDS)
    if len(hot):
        sent = staged(sent, "suffixes")
    replies = first.unionAll(sent.groupBy("part").applyInArrow(compare, MARKS))
    if len(hot):
        strings = staged(sent.where(F.col("part").isin(sorted({int(p) for v in hot for p in range(np.searchsorted(splitters, v), np.searchsorted(splitters, v, "right") + 1)})))
                         .groupBy("part").applyInArrow(boundary, "key long, doc long, chunk long, part long, nth long, o long"), "suffixes-frequent")
        least = staged(strings.groupBy("key").agg(F.min("doc").alias("earliest")), "suffixes-earliest")
        late = strings.join(least, "key").where(F.col("doc") > F.col("earliest")).groupBy("chunk", "part", "nth").agg(F.max("o").alias("most"), F.min("o").alias("least"))
        replies = replies.unionAll(late.groupBy("chunk", "part").applyInArrow(pack, MARKS))

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        s = Suffixes(table)
        r, t = s.met_again(replies, n1), s.text
        most, least = np.full(len(r.anchor), -1), np.full(len(r.anchor), 99)
        sent_to = dict(r.sent(splitters))
        for round_, part, blob in zip(replies.column("round").to_pylist(), replies.column("part").to_pylist(), replies.column("reply")):
            if round_ == 2:
                i, (m, l) = sent_to[part], np.frombuffer(blob.as_py(), np.uint8).reshape(2, -1).astype(np.int64)
                i, m, l = i[m < 255], m[m < 255], l[m < 255]
            elif round_ == 3:
                nth, m, l = np.frombuffer(blob.as_py(), np.int32).reshape(3, -1)
                i = sent_to[part][nth]
            else:
                continue
            most[i], least[i] = np.maximum(most[i], m), np.minimum(least[i], l)
        # who was spoken for: a later document loses all, the same one fares alike
        spoken, by = ~r.speaks, r.speaker
        later = spoken & (r.doc > r.doc[by])
        alike = spoken & ~later
        most[alike], least[alike] = most[by[alike]], least[by[alike]]
        most[later], least[later] = r.far[later], r.near[later]
        hit = most >= 0
        step = np.zeros(len(t.data) + 1, np.int32)
        np.add.at(step, r.anchor[hit] - most[hit], 1)
        np.add.at(step, r.anchor[hit] - least[hit] + WINDOW, -1)
        gone = np.cumsum(step)[:-1] > 0
        run = gone & ~np.concatenate([[False], gone[:-1]])
        n_gone, n_run = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, run))
        data = t.data[~gone].tobytes()
        kept = [data[b - n_gone[b]:e - n_gone[e]] for b, e in zip(t.begin, t.end)]
        return pa.table({
            "doc_id": t.doc_id, "n_bytes": pa.array(t.size), "n_removed": pa.array(n_gone[t.end] - n_gone[t.begin]),
            "n_spans": pa.array(n_run[t.end] - n_run[t.begin]), "kept": pa.array(kept, pa.binary()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])})

    return chunks.map_with(replies, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
