"""Personal data by candidate gradient boosting.

Three steps over every whole text:

* *Generators* of high recall propose overlapping spans: anything like an e-mail
  address, spelt-out ones (``name [at] host dot org``) included, and every window of
  neighbouring digit groups that could be an address of a host, a card or a
  phone number, however many groups it has and however wide the blanks, dots,
  slashes, dashes and brackets between them are: up to 19 digits, the most that
  any of these numbers has.
* *Boosted trees* (``GBTClassifier``) judge each candidate by its format (groups,
  separators, check digit, top-level label) and by the characters and words
  around it.
* *Calibrated thresholds*, one a kind, select: the least score from which on the
  precision on held-out examples is ``PRECISION``. Of overlapping selected
  candidates the one of higher score stays.

The plain forms of ``BASE`` (a pattern and a check a kind) are found whatever the
trees say, and nothing selected overlaps them.

Fitting takes a bounded sample of texts (``SAMPLE``, by hash of the text) only
for their surroundings: made-up addresses and numbers in plain and unusual
forms, and decoys of like looks (dates, versions, order and book numbers, failed
check digits, prose with "at"), are set into them, some with another of them right beside. No text of the corpus is
taken for a label, so the sample needs none. The examples are sorted into one
partition of bounded size, so that reruns fit the same trees.

Scoring is a map over the rows: no shuffle, no groups, a model of fixed size. A
text costs in proportion to its length.

Defined cases: null counts as empty; texts without a candidate have no spans;
rows alike are judged alike; a table without texts still gets a model; extra
columns stay, columns named like a result are replaced; an empty table stays
empty. Keys and passwords are no personal data here.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from .common import free_name

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 2500      # texts whose surroundings are learnt from
EXAMPLES = 6       # examples set into each
BESIDE = 0.3       # of them with another right beside
TREES, DEPTH = 20, 4
PRECISION = 0.99   # on held-out examples, a kind
AROUND = 32        # characters of context on each side
MOST_DIGITS = 19   # of a card, the longest of the numbers
SCORED = 20_000    # candidates whose features are held at once
RESULT = ("spans", "redacted")

# ---- plain forms

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# every number with its separators lies in one of these
_ISLAND = re.compile(r"[0-9][0-9 ()./:_\[\]-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")


def digits(s: str) -> str:
    return "".join(_NUMBER.findall(s))


def luhn(number: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def octet(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and (not short or int(short) <= 255)


def local_start(text: str, at: int, low: int) -> int:
    """Where the run of mailbox characters that ends before ``at`` begins."""
    while at > low and text[at - 1] in _LOCAL:
        at -= 1
    return at


def islands(text: str) -> list[tuple[int, int]]:
    """The parts of a text with numbers long enough to matter."""
    return [m.span() for m in _ISLAND.finditer(text) if m.end() - m.start() >= 7]


def base_spans(text: str, parts: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain forms, leftmost and non-overlapping a
    kind; a match that fails its check is dropped."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        start = local_start(text, at, done) if m else at
        if m and start < at:
            done = m.end()
            out.append(("email", start, done))
        at = text.find("@", at + 1)
    for s, e in parts:
        for m in _IP.finditer(text, s, e):
            if all(octet(p) for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text, s, e):
            number = digits(m.group())
            if 12 <= len(number) <= 19 and luhn(number):
                out.append(("card", *m.span()))
        if s and text[s - 1] == "+":
            m = _PHONE.match(text, s, e)
            if m and 9 <= len(digits(m.group())) <= 15:
                out.append(("phone", s - 1, m.end()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


# ---- candidates of unusual forms

_AT = re.compile(r" ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?| (?:at|AT) | ?[@＠] ?")
_LOOSE_DOT = r"(?: ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) |\.)"
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:" + _LOOSE_DOT + r"[A-Za-z0-9-]+)+")
_SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")


def candidates(text: str, parts: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Everything that could be personal data, overlaps included."""
    out = set()
    for m in _AT.finditer(text):
        host = _LOOSE_DOMAIN.match(text, m.end()) if m.start() and text[m.start() - 1] in _LOCAL else None
        if host:
            out.add(("email", local_start(text, m.start(), 0), host.end()))
    if text.count(":") > 1:
        out.update(("ip", *m.span()) for m in _SIX.finditer(text) if m.group().strip(":"))
    for s, e in parts:
        groups = [m.span() for m in _NUMBER.finditer(text, s, e)]
        for i, (a, _) in enumerate(groups):
            n = 0
            for j in range(i, len(groups)):
                b, n = groups[j][1], n + groups[j][1] - groups[j][0]
                if n > MOST_DIGITS:
                    break
                first = a - 1 if a and text[a - 1] in "+(" else a
                if first and first < a and text[first - 1] == "+":
                    first -= 1
                if j - i == 3 and n <= 12:
                    out.add(("ip", a, b))
                if 7 <= n <= 15:
                    out.add(("phone", first, b))
                if 12 <= n:
                    out.add(("card", a, b))
    return sorted(out)


# ---- features

# Words that often stand before such data, and before numbers that are none.
_CUES = (("mail", "contact", "write", "address"), ("ip", "host", "server", "node", "login"),
         ("card", "visa", "credit", "pay", "debit"), ("phone", "tel", "call", "mobile", "fax", "cell"))
_OTHER = ("order", "isbn", "version", "date", "invoice", "item", "page", "since", "total", "id", "ref", "nr", "no", "between", "score")
_TOP = frozenset(("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "jp"))
_WORD = re.compile(r"[a-z]+")


def side(c: str) -> int:
    """0 blank or end, 1 punctuation, 2 letter, 3 digit."""
    return 0 if not c or c.isspace() else 3 if c.isdigit() else 2 if c.isalpha() else 1


def features(text: str, kind: str, s: int, e: int) -> list[float]:
    """What the trees see of a candidate: its kind, format and context."""
    span, before, after = text[s:e], text[max(0, s - AROUND):s], text[e:e + AROUND]
    groups = _NUMBER.findall(span)
    number = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    between = _NUMBER.sub("\0", span).strip("\0").split("\0")
    marks = {x for x in between if x}
    labels = re.split(r"[^A-Za-z0-9-]+", span.lower())
    cues = _WORD.findall(before.lower())[-3:]
    around = before + after
    return [float(x) for x in (
        *(kind == k for k in KINDS),
        len(span), len(number), len(groups), max(sizes), min(sizes), sizes[-1], sizes[0],
        len(number) > 1 and luhn(number), number[:1] in tuple("3456"), len(set(number)), all(octet(g) for g in groups),
        len(marks), max((len(x) for x in marks), default=0), "." in marks, "-" in marks, " " in marks, "/" in span, span.count(":"), "::" in span,
        span[:1] == "+", span[:1] == "(", number[:2] == "00", number[:1] == "0",
        "@" in span or "＠" in span, "[" in span or "(" in span, " " in span, labels[-1] in _TOP, len(labels[-1]), "dot" in labels or "[.]" in span,
        1900 <= int(number[:4] or 0) <= 2100, len(number) >= 8 and number[4:6] <= "12" and number[6:8] <= "31",
        sizes[:3] in ([2, 2, 4], [4, 2, 2]), side(before[-1:]), side(after[:1]), before[-1:] in tuple(".,-/:"),
        after[:1] in tuple("-/:.([") and after[1:2].isdigit(), before[-2:-1].isdigit(),
        *(any(w.startswith(c) for w in cues for c in cue) for cue in _CUES), any(w in _OTHER for w in cues),
        sum(c.isdigit() for c in around) / max(1, len(around)))]


# ---- examples

def numbers(r: random.Random, n: int) -> str:
    return "".join(str(r.randrange(10)) for _ in range(n))


def checked(r: random.Random) -> str:
    """A card number with its check digit."""
    body = r.choice(("4", "5", "37", "6")) + numbers(r, 14)
    body = body[:14 if body[0] == "3" else 15]
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def name(r: random.Random) -> str:
    return "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(3, 9)))


def spelt(number: str, size: int, mark: str) -> str:
    return mark.join(number[i:i + size] for i in range(0, len(number), size))


def fours(number: str, mark: str) -> str:
    return spelt(number, 4, mark)


def genuine(r: random.Random) -> tuple[str, str]:
    """(kind, text) of made-up personal data, plain or unusual."""
    kind = r.choice(KINDS)
    if kind == "email":
        at = r.choice(("@", "@", " at ", " [at] ", "(at)", "[at]", "＠", " @ "))
        dot = "." if at in ("@", "＠", " @ ") else r.choice((" dot ", "[dot]", " [dot] ", "(dot)", "."))
        who = name(r) + r.choice(("", "." + name(r), numbers(r, 2)))
        return kind, who + at + name(r) + r.choice(("", numbers(r, 1))) + dot + r.choice(("example" + dot, "")) + r.choice(sorted(_TOP))
    if kind == "ip":
        if r.random() < 0.3:
            groups = ["%x" % r.randrange(1, 65536) for _ in range(8)]
            return kind, ":".join(groups) if r.random() < 0.5 else ":".join(groups[:r.randrange(1, 4)]) + "::" + ":".join(groups[5:])
        return kind, r.choice((".", ".", "[.]", " . ", " [.] ")).join(str(r.randrange(1, 256)) for _ in range(4))
    if kind == "card":
        mark, number = r.choice(("", " ", "-", ".", "/", "  ", "_")), checked(r)
        return kind, fours(number, mark) if r.random() < 0.85 else spelt(number, r.choice((1, 2)), r.choice((" ", "-", ".")))
    a, b, c, z = numbers(r, 3), numbers(r, 3), numbers(r, 4), r.choice("1234567")
    return kind, r.choice((f"+{z} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{z}{r.randrange(10)} {a} {b} {c}",
                           f"0{a}/{b}{c}", f"0{z} " + " ".join(numbers(r, 2) for _ in range(4)), f"+{z}{r.randrange(10)} {a} {b}{c}", f"{z}-{a}-{b}-{c}"))


def decoy(r: random.Random) -> str:
    """Text that looks like personal data and is none."""
    y, m, d = r.randrange(1900, 2050), r.randrange(1, 13), r.randrange(1, 32)
    card = checked(r)
    wrong = card[:-1] + str((int(card[-1]) + r.randrange(1, 10)) % 10)
    return r.choice((
        f"{y}-{m:02d}-{d:02d} {r.randrange(24):02d}:{r.randrange(60):02d}", f"{d:02d}.{m:02d}.{y}", f"{y}/{m:02d}/{d:02d}", f"{y}{m:02d}{d:02d}",
        f"{y}{m:02d}{d:02d}{numbers(r, 6)}", f"{r.randrange(24)}:{r.randrange(60):02d}:{r.randrange(60):02d}",
        f"{y}-{y + 5}, {y + 9}-{y + 12}", f"{y}-{y + 3}", f"978-{numbers(r, 1)}-{numbers(r, 2)}-{numbers(r, 6)}-{numbers(r, 1)}",
        ".".join(str(r.randrange(1, 12)) for _ in range(5)), ".".join(str(r.randrange(256, 1000)) for _ in range(4)),
        f"{numbers(r, 1)} {numbers(r, 3)} {numbers(r, 3)}", f"{numbers(r, 2)}.{numbers(r, 3)}.{numbers(r, 3)},{numbers(r, 2)}",
        wrong, fours(wrong, r.choice(" -.")), numbers(r, r.randrange(7, 12)), numbers(r, r.randrange(12, 20)), numbers(r, 25),
        " ".join(numbers(r, 1) for _ in range(14)), " ".join(numbers(r, 2) for _ in range(9)), spelt(wrong, r.choice((1, 2)), r.choice(" -.")),
        (" " * r.randrange(4, 12)).join(numbers(r, r.randrange(1, 5)) for _ in range(r.randrange(3, 9))),
        f"{name(r)} at {name(r)}.{name(r)}", f"{name(r)} at {name(r)} dot {name(r)}", f"look at the {name(r)} dot", f"{numbers(r, 1)}:{numbers(r, 2)}:{numbers(r, 2)}:{numbers(r, 1)}",
        f"{numbers(r, 3)}/{numbers(r, 4)}/{numbers(r, 3)}", f"{numbers(r, 4)}-{numbers(r, 7)}"))


def examples(text: str) -> Iterator[tuple[float, int, int, list[float]]]:
    """(label, kind, fold, features) of examples set into a text; they depend
    on the text only."""
    r = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    for i in range(EXAMPLES):
        place = text.find(" ", r.randrange(len(text) + 1))
        before, after = (text[max(0, place - 60):place + 1], text[place:place + 60]) if place > 0 else (text[:60] + " ", " ")
        kind, said = genuine(r) if i % 2 else (None, decoy(r))
        cue = r.random()
        if cue < 0.35 and kind:
            before += r.choice(_CUES[KINDS.index(kind)]) + r.choice((" ", ": "))
        elif cue < 0.35:
            before += r.choice(_OTHER if cue < 0.2 else r.choice(_CUES)) + r.choice((" ", ": "))
        after = r.choice(("", ".", ",", ")")) + after
        if r.random() < BESIDE:  # another number or address stands right beside it
            other = r.choice((" ", " ", ", ")).join(("", genuine(r)[1] if r.random() < 0.7 else decoy(r), ""))
            before, after = (before[:-1] + other, after) if r.random() < 0.4 else (before, other + after.lstrip(".,) "))
        whole = before + said + after
        first = len(before)
        parts = islands(whole)
        for k, s, e in candidates(whole, parts):
            if e <= first or s >= first + len(said):
                continue
            right = kind == k and s == first and e == first + len(said)
            if right or not kind or (kind != k and s == first and e == first + len(said)) or r.random() < 0.2:
                yield float(right), KINDS.index(k), r.randrange(3), features(whole, k, s, e)


# ---- the model

@dataclass(frozen=True)
class Model:
    """Trees as arrays: feature (-1 at a leaf), threshold, left child (the right
    one follows it) and value a node; a weight a tree; a threshold a kind."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    least: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        row = np.arange(len(x))
        for t in range(len(self.weight)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = self.feature[t, at]
                down = self.left[t, at] + (x[row, np.maximum(f, 0)] > self.cut[t, at])
                at = np.where(f < 0, at, down)
            margin += self.weight[t] * self.value[t, at]
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


def read_trees(fitted, least: np.ndarray) -> Model:
    size = (1 << (DEPTH + 1)) - 1
    trees = list(fitted._java_obj.trees())
    shape = (len(trees), size)
    feature, cut, left, value = np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape)
    for t, tree in enumerate(trees):
        queue, used = [(0, tree.rootNode())], 1
        for at, node in queue:
            value[t, at] = node.prediction()
            if node.subtreeDepth():
                feature[t, at], cut[t, at], left[t, at] = node.split().featureIndex(), node.split().threshold(), used
                queue += [(used, node.leftChild()), (used + 1, node.rightChild())]
                used += 2
    return Model(feature, cut, left, value, np.array(fitted.treeWeights), least)


def thresholds(score: np.ndarray, label: np.ndarray, kind: np.ndarray, precision: float) -> np.ndarray:
    """A kind's least score from which on held-out examples reach the precision
    (2, so none, if it is never reached)."""
    least = np.full(len(KINDS), 2.0)
    for k in range(len(KINDS)):
        mine = np.flatnonzero(kind == k)
        order = mine[np.argsort(-score[mine], kind="stable")]
        right = np.cumsum(label[order]) / np.arange(1, len(order) + 1)
        # only where the score changes: equal scores are selected together
        ends = np.flatnonzero(np.append(score[order][1:] != score[order][:-1], True)) if len(order) else np.zeros(0, int)
        good = ends[right[ends] >= precision]
        if len(good):
            least[k] = max(0.5, score[order[good[-1]]])
    return least


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION, text: str = "text") -> Model:
    """A model whose examples stand in the surroundings of ``sample`` texts."""
    spark = docs.sparkSession
    given = docs.select(docs[text].alias("text")).where("text IS NOT NULL")
    n = given.count()
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = given.where(draw < min(1.0, sample / max(1, n))).select(F.xxhash64("text").alias("h"), "text").dropDuplicates(["h"]).limit(2 * sample)
    # surroundings without a text, as many as the sample is short of
    blank = spark.range(0, max(200, sample - n), 1, 1).select(F.lit(None).cast("long").alias("h"), F.concat(F.lit("made up "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"), F.lit(" words")).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [x for t in b.column("text").to_pylist() for x in examples(t)]
            label, kind, fold, x = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.float64()), pa.array(kind, pa.int32()), pa.array(fold, pa.int32()),
                                              pa.array(x, pa.list_(pa.float64()))], names=["label", "kind", "fold", "x"])

    made = chosen.unionByName(blank).mapInArrow(make, "label double, kind int, fold int, x array<double>")
    # a bounded number of rows, always in one order: reruns fit the same trees
    made = made.repartition(1).sortWithinPartitions("label", "kind", "fold", "x").withColumn("features", array_to_vector("x")).persist()
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False).fit(made.where("fold > 0"))
    held = made.where("fold = 0").select("label", "kind", "x").toArrow()
    made.unpersist()
    model = read_trees(fitted, np.full(len(KINDS), 2.0))
    x = np.array(held.column("x").to_pylist(), float).reshape(held.num_rows, -1)
    least = thresholds(model.scores(x) if len(x) else np.zeros(0), held.column("label").to_numpy(), held.column("kind").to_numpy(), precision)
    return Model(model.feature, model.cut, model.left, model.value, model.weight, least)


# ---- the operator

SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def selected(text: str, base: list, found: list, score: np.ndarray, least: np.ndarray) -> list[tuple[str, int, int, float, bool]]:
    """The plain spans, and the candidates over their threshold that overlap
    neither a plain span nor a better candidate."""
    out = [(k, s, e, 1.0, True) for k, s, e in base]
    good = sorted((-score[i], s - e, s, k) for i, (k, s, e) in enumerate(found) if score[i] >= least[KINDS.index(k)])
    taken: list[tuple[int, int]] = []  # disjoint, sorted
    for _, s, e in base:
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    for neg, size, s, k in good:
        e = s - size
        at = bisect.bisect_left(taken, (s, -1))
        if not (at and taken[at - 1][1] > s) and not (at < len(taken) and taken[at][0] < e):
            taken.insert(at, (s, e))
            out.append((k, s, e, -neg, False))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redacted(text: str, spans: list) -> str:
    """The text with each span replaced by its kind in brackets; overlapping
    spans are replaced together, under the first one's kind."""
    out, at = [], 0
    for k, s, e, *_ in spans:
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def scored(model: Model, found: Iterator[tuple[str, tuple]]) -> np.ndarray:
    """The scores of (text, candidate), ``SCORED`` at a time."""
    out = [np.zeros(0)]
    while x := [features(t, *c) for t, c in itertools.islice(found, SCORED)]:
        out.append(model.scores(np.array(x, float)))
    return np.concatenate(out)


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with spans (kind, start, end in code points, score, base) by
    start, and the redacted text (null for null)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind_t = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])

    @F.arrow_udf(f"struct<spans:{SPANS},redacted:string>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            known = [t.as_py() for t in texts]
            parts = [islands(t or "") for t in known]
            found = [candidates(t or "", p) for t, p in zip(known, parts)]
            score = scored(m, ((t, c) for t, cs in zip(known, found) for c in cs))
            at, spans, texts_out = 0, [], []
            for t, p, cs in zip(known, parts, found):
                mine = selected(t or "", base_spans(t or "", p), cs, score[at:at + len(cs)], m.least)
                at += len(cs)
                spans.append([dict(zip(("kind", "start", "end", "score", "base"), s)) for s in mine])
                texts_out.append(None if t is None else redacted(t, mine))
            yield pa.StructArray.from_arrays([pa.array(spans, pa.list_(kind_t)), pa.array(texts_out, pa.string())], names=["spans", "redacted"])

    own, = free_name(docs, "judged")
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    out = docs.select(*[docs[f"`{c}`"] for c in kept], judge(docs[text]).alias(own))
    return out.select(*[out[f"`{c}`"] for c in kept], F.col(f"{own}.spans").alias("spans"), F.col(f"{own}.redacted").alias("redacted"))
