"""Small tables with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)

# clashing names: results and helper columns of the operators
CLASHES = ["size", "Target", "copies", "h", "th", "lines", "lost", "keep", "drop", "kept", "clean_text", "n", "chunk", "ord",
           "row", "rest", "score", "lang_pred", "host", "rule", "judged"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def sentence(seed: int, n: int) -> str:
    """n made-up words, always the same for a seed."""
    out, x = [], seed * 2654435761 % (1 << 32) + 1
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % (1 << 32)
        out.append("w" + "abcdefgh"[x >> 29] + str((x >> 8) % 9000))
    return " ".join(out)


def texts() -> list:
    a, b, c = sentence(1, 120), sentence(2, 90), sentence(3, 60)
    shared = "A line that several documents share, in full."
    passage = sentence(9, 45)
    long_ = "\n".join(sentence(100 + i, 40) + "." for i in range(400))
    return [
        (1, a, "en", "s1"), (2, a, "en", "s1"), (2, a, "en", "s1"),             # copies, a repeated row
        (3, a.replace("w", "W", 7), "en", "s2"),                              # differs in case only
        (4, b + "\n" + shared + "\n" + passage, "de", "s2"), (5, c + "\n  " + shared.upper() + "\t\n" + passage, "de", None),
        (6, sentence(4, 80) + "\n" + shared, None, "s3"), (7, shared + "\n" + shared, "en", "s3"),
        (8, None, "en", "s1"), (9, "", "en", "s1"), (10, " \t\n \r\n", "fr", "s9"), (None, b, "en", "s1"), (None, None, None, None),
        (11, "one two", "en", "é"), (12, "ONE  two", "en", "é"), (13, "one", None, "s1"),
        (14, "x " * 300, "en", "s1"), (15, "aaaa" * 60, "en", "s1"), (16, "aaaa" * 70, "en", "s1"),
        (17, "Größe ÄÖÜ ß é " * 12, "de", "s2"), (18, "größe ÄÖÜ ß é " * 12, "de", "s2"),
        (19, long_, "en", "s1"), (20, long_[500:], "en", "s2"), (21, "1234 5678 !!! ### ", None, "s3"),
        (22, b + " " + sentence(5, 10), "de", "s1"), (23, sentence(6, 5) + " " + b, "de", "s1"),
        (24, "日本語の文章です。 これは試験です。 もう一つの文です。 " * 5, "ja", "s3"), (25, "\U0001F600 emoji \U0001F600 " * 20, "en", "s3"),
        (26, passage + " " + passage, "en", "s3"), (27, "Home | About | Contact | Login\n" + c + ".", "en", "s1"),
    ]


def rows(given=None) -> list:
    return [(*r, None if r[1] is None else len(r[1]), *[f"x{i}" for i in range(len(CLASHES))]) for r in (texts() if given is None else given)]


def frame(spark, given=None):
    return spark.createDataFrame(rows(given), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def kept_lines(docs, min_docs=3):
    """(lines, lines dropped, text left) of each document."""
    keyed = lambda t: [(x, x.strip(BLANKS).translate(FOLD)) for x in (t or "").split("\n")]
    where = {}
    for i, t, *_ in docs:
        for _, k in keyed(t):
            if len(k) >= 20:
                where.setdefault(k, set()).add(i)
    keeper = {k: max((x for x in v if x is not None), default=None) for k, v in where.items() if len(v) >= min_docs}
    out = []
    for i, t, *_ in docs:
        all_ = keyed(t)
        kept = [x for x, k in all_ if k not in keeper or keeper[k] == i]
        out.append((len(all_), len(all_) - len(kept), "\n".join(kept)))
    return out


def line_dedup(docs, min_docs=3):
    return [(d[0], n, dropped, sha(text)) for d, (n, dropped, text) in zip(docs, kept_lines(docs, min_docs))]


def suffix_dedup(docs, n=50):
    low = lambda i: -1 if i is None else i
    first = {}
    for i, t, *_ in docs:
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            s = b[k:k + n]
            first[s] = min(first.get(s, 1 << 60), low(i))
    out = []
    for i, t, *_ in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if first[b[k:k + n]] < low(i):
                gone[k:k + n] = b"\1" * n
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def substring_dedup(docs, n=35):
    count = {}
    for _, t, *_ in docs:
        w = words(t)
        for k in range(len(w) - n + 1):
            count[tuple(w[k:k + n])] = count.get(tuple(w[k:k + n]), 0) + 1
    out = []
    for i, t, *_ in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if count[tuple(w[k:k + n])] > 1:
                gone[k:k + n] = [True] * n
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def shingles(text):
    w = words((text or "").translate(FOLD))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def jaccard_groups(docs):
    """The shingle set and the group (a number) of each document."""
    sets = [shingles(t) for _, t, *_ in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for x in range(len(docs)):
        for y in range(x):
            i = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * i >= 75 * len(sets[x] | sets[y]):
                up[root(x)] = root(y)
    return sets, [root(x) for x in range(len(docs))]


def jaccard(docs):
    sets, group = jaccard_groups(docs)
    least = {}
    for x, d in enumerate(docs):
        if d[0] is not None:
            least[group[x]] = min(least.get(group[x], d[0]), d[0])
    return [(d[0], len(sets[x]), least.get(group[x]) if sets[x] else d[0]) for x, d in enumerate(docs)]


def distinct(docs):
    """How many rows of each doc_id stay if each group keeps that of its least."""
    sets, group = jaccard_groups(docs)
    ids = [d[0] for x, d in enumerate(docs) if not sets[x]]
    for g in {g for x, g in enumerate(group) if sets[x]}:
        ids.append(min((docs[x][0] for x in range(len(docs)) if group[x] == g and docs[x][0] is not None), default=None))
    return Counter(ids)


def mix(docs, weights=(3, 1, 2)):
    size = [len(words(t)) for _, t, *_ in docs]
    source = [d[3] for d in docs]
    total = {}
    for s, n in zip(source, size):
        total[s] = total.get(s, 0) + n
    names = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None] * (None in total)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > 2 * total[s]}
        if not full:
            target |= {s: weight[s] * unit for s in open_}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= full
    return size, source, total, target


def mix_copies(docs):
    """How often the mix takes each document."""
    size, source, total, target = mix(docs)
    low = [int(hashlib.md5(f"{'-' if d[0] is None else d[0]}:{d[1] or ''}".encode()).hexdigest()[:15], 16) for d in docs]
    copies = [0] * len(docs)
    for s in total:
        mine = [x for x in range(len(docs)) if source[x] == s]
        passes = int(target[s] // total[s]) if total[s] else 0
        rest, at, upto = target[s] - passes * total[s], 0, 0
        for h in sorted({low[x] for x in mine}) if rest > 0 else []:
            before, upto = upto, upto + sum(size[x] for x in mine if low[x] == h)
            if upto >= rest:
                at = h + 1 if upto - rest <= rest - before else h
                break
        for x in mine:
            copies[x] = passes + (low[x] < at)
    return copies


def language(text, model):
    """The language that a model gives a text, and whether it is ambiguous."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not letters.strip() or not model.languages:
        return "und", True
    if len(model.languages) == 1:
        return model.languages[0], False
    run = f" {re.sub(' +', ' ', letters)} "
    odd = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
    whole, seen = (1 << 64) - 1, Counter()
    for i in range(len(run)):
        h = 0
        for n, c in enumerate(run[i:i + 4]):
            h = ((h ^ (h >> 29)) * odd[n] + ord(c) * odd[0]) & whole if n else ord(c) * odd[0] & whole
            seen[((h ^ (h >> 32)) * odd[3] & whole) >> 51] += 1
    bits = range(model.code.shape[1])
    margin = [sum(n * model.weights[g, b] for g, n in seen.items()) / sum(seen.values()) for b in bits]
    loss = [sum(model.trust[b] * math.log1p(math.exp(-8 * word[b] * margin[b])) for b in bits) / sum(model.trust) for word in model.code]
    best = loss.index(min(loss))
    near = False
    for k in range(len(loss)):
        own, back = model.gaps[best][k], model.gaps[k][best]
        back = back if back > 0 else own
        least = max(0.0, own / 3, own * 2 / 3 - back / 3)  # two thirds in the best, one in the other
        near |= k != best and loss[k] - loss[best] <= least
    return model.languages[best], near
