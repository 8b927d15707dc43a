"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np
import pytest

from gazette.llm import lexical
from gazette.llm.common import prepare
from tests.llm import data as D

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall((text or "").translate(D.FOLD))


def brute(docs, items, k=10):
    docs = [(i, cut(t)) for i, t, *_ in docs]
    docs = [(i, t) for i, t in docs if t]
    n, total = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, t in docs:
            m = 25 + 75 * len(t) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10 ** 9 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x in cut(text) if x in df)
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


def ranked(spark, docs, items, **more):
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    return order(tuple(r) for r in lexical.rank(docs, table, **more).collect())


ITEMS = [(1, D.sentence(2, 30)), (1, D.sentence(2, 30)), (2, "one ONE two"), (3, None), (4, ""), (5, "!!! ..."), (6, "größe ÄÖÜ ß"), (7, "日本語の文章です nothing"),
         (8, "no such words anywhere"), (9, "x"), (None, "Home About"), (10, D.sentence(101, 40) + " several documents share"), (11, "\U0001F600"), (12, "1234"), (13, "one\x00two\x7ftwo")]


@pytest.mark.parametrize("chunk", [3, 2048])
@pytest.mark.parametrize("block_items", [4, 2000])
def test_odd_rows(spark, monkeypatch, chunk, block_items):
    prepare(spark)
    monkeypatch.setattr(lexical, "CHUNK", chunk)
    got = ranked(spark, D.frame(spark).repartition(3), ITEMS, block_items=block_items)
    assert got == order(brute(D.texts(), ITEMS))


def test_empty(spark):
    prepare(spark)
    assert ranked(spark, D.empty(spark), ITEMS) == []
    assert ranked(spark, D.frame(spark), []) == []
    assert ranked(spark, D.frame(spark), [(1, None)]) == []


def test_ties_go_by_doc_id(spark):
    prepare(spark)
    docs = [(i, "alpha beta gamma", "en", "s") for i in range(60)] + [(100 + i, f"delta {i}", "en", "s") for i in range(60)]
    items = [(1, "alpha"), (2, "delta"), (3, "alpha delta 7")]
    assert ranked(spark, D.frame(spark, docs).repartition(5), items) == order(brute(docs, items))


def test_terms_in_pieces(monkeypatch):
    text = "Ärger, Wort_Zahl\t12a x y " * 50 + "z" * 100
    whole = [t for p in lexical.terms(text) for t in p]
    assert whole == [t.encode() for t in cut(text)]
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert [t for p in lexical.terms(text) for t in p] == whole
    assert list(lexical.terms(None)) == list(lexical.terms("")) == []


def test_search_equals_full_scores_and_stops_early():
    """Random chunks: the same best documents as scoring all, and, where a few
    documents stand out, far fewer masks than there are."""
    r = random.Random(3)
    few = 0
    for trial in range(60):
        n = r.choice((1, 5, 300))
        holds = [np.array(sorted(r.sample(range(40), r.randrange(0, 30))), "<i4") for _ in range(n)]
        times = [np.array([r.randrange(1, 4) for _ in h], "<i4") for h in holds]
        weights = np.array([r.choice((0, 50, 700, 5000)) for _ in range(40)], np.int64)
        m = [r.randrange(25, 300) for _ in range(n)]
        chunk = lexical.Chunk(list(range(n)), holds, times, m, weights)
        item = [(t, r.randrange(1, 3)) for t in r.sample(range(40), r.randrange(1, 25))]
        full = []
        for i in range(n):
            tf = dict(zip(holds[i].tolist(), times[i].tolist()))
            s = sum(q * int(weights[t]) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m[i])) for t, q in item if t in tf)
            if s > 0:
                full.append((-s, i))
        best = lexical.Best(10)
        evaluated = lexical.search(chunk, item, best)
        assert sorted((-s, d) for s, _, _, d in best.heap) == sorted(full)[:10]
        few += evaluated < len(full) / 2
    assert few > 10
