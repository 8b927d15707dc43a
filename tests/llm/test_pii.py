"""Personal data: the plain forms against their patterns, the others by what is
caught and what is left alone."""

import re
import time

import pytest
from pyspark.sql import functions as F

from gazette.llm import pii
from gazette.llm.common import prepare
from tests.conftest import SF01
from tests.llm import data as D

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The plain forms by their patterns alone."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number))]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                    "card": 12 <= len(number) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(number) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], list(PATTERNS).index(x[0])))


ODD = [
    "", "@", "a@b", "a@b.c", "@a.b@c.d", "x@a.b@c.d e@f.g.", "a@b..c", "a+b%c@d-e.f-g", "Ä@b.cc ä.x@y.zz", "..@a.b", "a@b.c@", "mail: <me@host.example.org>.",
    "1.2.3.4", "1.2.3.4.5", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.1.1.1", "00000000000000000000001.1.1.1", "1.2.3", "1..2.3.4", "a1.2.3.4b", "1.2.3.4@5.6.7.8",
    "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111 1111 1111", "4111 1111 1111 1112", "0", "0 0", "000000000000", "4111 1111 1111 1111 1",
    "+1 (743) 555-3824", "+1 (826) 555-4081 190.137.223.204", "++1 555 555 5555", "+1", "+1-", "+1 2", "+123456789", "+1234567890123456", "+1 (2) 3.4-5 6 7 8 9 0) -", "+1 23/456789012",
    "é +49 30 123456 é", "日本 1.2.3.4 語", "\U0001F600 4111111111111111 \U0001F600", "1\n2\n3\n4 1.1.1.1\n2.2.2.2", "+1 234\n567890", "٤١١١ 1.2.3.4",
    "[1.2.3.4]:80 (4111111111111111)", "12:30:45 1.2.3.4_5", "-4111111111111111-", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0",
]


def test_plain_forms_equal_their_patterns():
    for text in ODD:
        assert pii.base_spans(text, pii.islands(text)) == plain(text), text


def test_plain_forms_on_random_texts():
    import random
    r = random.Random(5)
    for _ in range(20000):
        text = "".join(r.choice("0123456789 .-+()@a/:é\n") for _ in range(r.randrange(40)))
        assert pii.base_spans(text, pii.islands(text)) == plain(text), text


def test_features_have_one_length_and_no_gaps():
    sizes = set()
    for text in ODD:
        for c in pii.candidates(text, pii.islands(text)):
            x = pii.features(text, *c)
            assert all(v == v for v in x)
            sizes.add(len(x))
    assert len(sizes) == 1


def test_long_texts_cost_in_proportion():
    for unit in ("1", "1.", "1 ", "a@", "a.", "+1 ", "1:", " at a dot ", "@", "(", "a"):
        text = unit * (400_000 // len(unit))
        begin = time.time()
        parts = pii.islands(text)
        pii.base_spans(text, parts)
        pii.candidates(text[:100_000], pii.islands(text[:100_000]))
        assert time.time() - begin < 20, unit


@pytest.fixture(scope="module")
def model(spark):
    prepare(spark)
    return pii.fit(spark.read.parquet(f"{SF01}/documents.parquet"))


def found(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(docs, model).orderBy("doc_id").collect()
    return [[(s["kind"], t[s["start"]:s["end"]], s["base"]) for s in r["spans"]] for t, r in zip(texts, rows)]


def test_unusual_forms_are_caught(spark, model):
    said = {
        "call me at (743) 555-3824 tonight": ("phone", "(743) 555-3824"),
        "write to john.doe [at] example [dot] com now": ("email", "john.doe [at] example [dot] com"),
        "jane at example dot org knows": ("email", "jane at example dot org"),
        "the card 4111.1111.1111.1111 was": ("card", "4111.1111.1111.1111"),
        "a +1 (826) 555-4081 190.137.223.204 b": ("phone", "+1 (826) 555-4081"),
    }
    for text, got in zip(said, found(spark, model, list(said))):
        assert (*said[text], False) in got, text


def test_numbers_and_prose_are_left_alone(spark, model):
    texts = ["on 2024-05-17 10:30 we met", "between 1990-1995 and 2001-2004", "order 123456789 came", "isbn 978-3-16-148410-0 a", "look at this.value there",
             "number 4111111111111112 here", "at 10:30:45 sharp", "it was 17.05.2024 then", "a sum of 1.234.567,89 in all", "the file is 12345678 bytes", *[D.sentence(i, 80) for i in range(40)]]
    assert [x for x in found(spark, model, texts) if x] == []


def test_odd_rows(spark, model):
    given = D.texts() + [(100 + i, t, "en", "s") for i, t in enumerate(ODD)]
    out = pii.find(D.frame(spark, given).repartition(3), model)
    assert {c.lower() for c in D.CLASHES} <= {c.lower() for c in out.columns} and out.columns[-2:] == ["spans", "redacted"]
    rows = out.collect()
    key = lambda i, t, *_: (i is None, i or 0, t is None, t or "")
    for g, r in zip(sorted(given, key=lambda g: key(*g)), sorted(rows, key=lambda r: key(r["doc_id"], r["text"]))):
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] == plain(g[1])
        assert (r["redacted"] is None) == (g[1] is None)
        added = [s for s in r["spans"] if not s["base"]]
        for s in added:
            assert not any(s["start"] < o["end"] and o["start"] < s["end"] for o in r["spans"] if o is not s)
    assert pii.find(D.empty(spark), model).count() == 0


def test_redaction(spark, model):
    docs = spark.createDataFrame([(1, "mail me@host.example.org or +1 (743) 555-3824.")], "doc_id long, text string")
    assert pii.find(docs, model).first()["redacted"] == "mail [EMAIL] or [PHONE]."


def test_models_of_a_table_agree(spark, model):
    again = pii.fit(spark.read.parquet(f"{SF01}/documents.parquet").repartition(7))
    assert (again.cut == model.cut).all() and (again.value == model.value).all() and (again.least == model.least).all()


def test_no_texts_still_give_a_model(spark):
    prepare(spark)
    m = pii.fit(D.empty(spark))
    assert (m.least <= 1).all()
    assert found(spark, m, ["call (743) 555-3824 now"]) == [[("phone", "(743) 555-3824", False)]]


def test_scores_equal_the_fitted_trees(spark):
    """The arrays read from the trees give what the library's own model gives."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    import numpy as np
    x = [f for t in D.texts() if t[1] for _, _, _, f in pii.examples(t[1])]
    y = [l for t in D.texts() if t[1] for l, _, _, _ in pii.examples(t[1])]
    df = spark.createDataFrame(list(zip(y, x)), "label double, x array<double>").withColumn("features", array_to_vector("x")).coalesce(1)
    fitted = GBTClassifier(maxIter=5, maxDepth=pii.DEPTH, stepSize=0.3, seed=7).fit(df)
    p = [r[0] for r in fitted.transform(df).select(F.get(vector_to_array("probability"), F.lit(1))).collect()]
    assert np.allclose(pii.read_trees(fitted, np.zeros(4)).scores(np.array(x)), p)


def test_numbers_of_many_groups_are_proposed():
    """Neither the groups of a number, nor how far they stand apart, nor what
    else a text holds decides whether it is looked at."""
    card = "4111111111111111"
    for text, kind in ((" ".join(card), "card"), ("-".join(card[i:i + 2] for i in range(0, 16, 2)), "card"), (" ".join("15553201987"), "phone"),
                       ("4111    1111    1111    1111", "card"), ("10 [.] 20 [.] 30 [.] 40", "ip"), ("::1", "ip"),
                       ("jane [at] example.org", "email"), ("jane(at)example.org", "email")):
        assert (kind, 0, len(text)) in pii.candidates(text, pii.islands(text)), text
        assert (kind, 2, 2 + len(text)) in pii.candidates(f"x {text} y", pii.islands(f"x {text} y")), text


def test_cards_in_small_groups_are_caught(spark, model):
    texts = ["pay with card 41-11-11-11-11-11-11-11 today", "card 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 is", "mail jane [at] example.org now"]
    got = found(spark, model, texts)
    assert [[(k, t) for k, t, _ in g] for g in got] == [[("card", "41-11-11-11-11-11-11-11")], [("card", " ".join("4" + "1" * 15))], [("email", "jane [at] example.org")]]


def test_scores_do_not_depend_on_how_many_are_held(spark, model, monkeypatch):
    import numpy as np
    every = [(t, c) for t in ODD for c in pii.candidates(t, pii.islands(t))]
    whole = pii.scored(model, iter(every))
    monkeypatch.setattr(pii, "SCORED", 3)
    assert len(every) > 20 and np.array_equal(pii.scored(model, iter(every)), whole) and len(pii.scored(model, iter([]))) == 0
