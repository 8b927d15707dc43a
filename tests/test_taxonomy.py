import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from gazette.operators import taxonomy as tx
from tests.conftest import SF001

DICT = {
    "energy": {"grid": ["Power Grid", "substation"], "storage": ["battery"]},
    "nuclear": {"fission": ["reactor"], "decommissioning": ["廃炉"]},
    "broken": ["not", "a", "dict"],
    "exclude": ["Recruitment"],
    "tender_type_hints": {"subsidy": ["grant"], "commissioned": ["contract"]},
}


@pytest.fixture(scope="module")
def tax():
    return tx.Taxonomy.from_dict(DICT)


def classify(spark, tax, title, desc=None, method="expr"):
    df = spark.createDataFrame([(1, title, desc)], "k long, title string, description string")
    return tx.categorise(df, tax, method=method, key="k").first()["categories"]


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tx.Taxonomy.from_json(tmp_path / "missing.json")
    p = tmp_path / "list.json"
    p.write_text(json.dumps(["x"]))
    with pytest.raises(ValueError):
        tx.Taxonomy.from_json(p)


def test_non_dict_category_skipped(tax):
    assert tax.category_names == ["energy", "nuclear"]


def test_case_insensitive_substring(spark, tax):
    assert classify(spark, tax, "New POWER GRIDS upgrade") == {"energy": ["grid"]}


def test_nfd_text_matches_nfc_keyword(spark, tax):
    t = tx.Taxonomy.from_dict({"c": {"s": ["café"]}})
    assert classify(spark, t, unicodedata.normalize("NFD", "Le café")) == {"c": ["s"]}
    t2 = tx.Taxonomy.from_dict({"c": {"s": [unicodedata.normalize("NFD", "café")]}})
    assert classify(spark, t2, "Le café") == {"c": ["s"]}


def test_subs_sorted_and_dictionary_order(spark, tax):
    got = classify(spark, tax, "reactor", "battery and substation; 廃炉")
    df = spark.createDataFrame([("reactor", "battery and substation; 廃炉")], "title string, description string")
    keys = tx.categorise(df, tax).select(F.map_keys("categories")).first()[0]
    assert keys == ["energy", "nuclear"]       # dictionary order inside Spark
    assert got["energy"] == ["grid", "storage"]
    assert got["nuclear"] == ["decommissioning", "fission"]


def test_match_across_title_description_joint(spark):
    t = tx.Taxonomy.from_dict({"c": {"s": ["power grid"]}})
    assert classify(spark, t, "power", "grid") == {"c": ["s"]}


def test_no_match_is_empty(spark, tax):
    assert classify(spark, tax, "nothing here") == {}


def test_join_form_equals_expr_form(spark, tax):
    for title, desc in [("reactor", "battery and substation; 廃炉"), ("x", None), ("POWER GRID", "grant"), ("", "")]:
        assert classify(spark, tax, title, desc, "expr") == classify(spark, tax, title, desc, "join")


def test_forms_agree_on_documents(spark):
    from gazette.plans import bindings as B
    n = B.documents_intake(spark, SF001)
    a = tx.categorise(n, B.taxonomy()).select("ord", F.to_json("categories").alias("c"))
    b = tx.categorise(n, B.taxonomy(), method="join", key="ord").select("ord", F.to_json("categories").alias("c"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_forms_agree_on_a_large_dictionary(spark):
    words = [f"k{i}w" for i in range(5000)] + ["é", "ab", "😀x"]
    t = tx.Taxonomy.from_dict({"a": {"one": words[::2], "two": words[1::2]}, "b": {"three": words[:50], "none": []}})
    rows = [(i, f"title k{i * 7}w", f"text K{i * 11}W and é" if i % 3 else "😀x ab") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, title string, description string")
    got = {r["k"]: r["categories"] for r in tx.categorise(df, t, method="join", key="k").collect()}
    for i, title, desc in rows:
        text = f"{title} {desc}".lower()
        expected = {c: sorted(s for s, ws in subs if any(w in text for w in ws)) for c, subs in t.categories}
        assert got[i] == {c: v for c, v in expected.items() if v}


def _label(spark, tax, title, desc=None):
    df = spark.createDataFrame([(title, desc)], "title string, description string")
    from gazette.functions.text import match_text, norm_lower
    return df.select(tx.pre_label_expr(norm_lower(match_text("title", "description")), tax)).first()[0]


def test_pre_label(spark, tax):
    assert _label(spark, tax, "Research grant") == "subsidy"
    assert _label(spark, tax, "Service contract") == "commissioned"
    assert _label(spark, tax, "grant", "contract") == "unknown"
    assert _label(spark, tax, "nothing") == "unknown"
    no_hints = tx.Taxonomy.from_dict({"c": {"s": ["x"]}})
    assert _label(spark, no_hints, "grant") == "unknown"


def test_exclude_title_only(spark, tax):
    df = spark.createDataFrame([("Staff RECRUITMENT notice", None), ("ok", "recruitment"), ("", None)],
                               "title string, description string")
    from gazette.functions.text import norm_lower
    got = [r[0] for r in df.select(tx.exclude_expr(norm_lower("title"), tax)).collect()]
    assert got == [True, False, False]


def test_hits(spark, tax):
    df = spark.createDataFrame([("reactor battery substation", None), ("none", None)], "title string, description string")
    c = tx.categorise(df, tax)
    rows = c.select(tx.hits_json(F.col("categories")).alias("j"),
                    F.array_join(tx.flatten_hits(F.col("categories")), ",").alias("f")).collect()
    assert json.loads(rows[0]["j"]) == ["grid", "storage", "fission"]
    assert rows[0]["f"] == "fission,grid,storage"
    assert rows[1]["j"] is None


def test_prepare_stages(spark, tax):
    df = spark.createDataFrame([("Recruitment reactor", None), ("plain", None), ("reactor grant", None)],
                               "title string, description string")
    st = [r["stage"] for r in tx.prepare(df, tax).collect()]
    assert st == ["excluded", "no_category", "kept"]


def test_pieces_form_with_many_words_that_begin_alike(spark):
    """5,000 words with one beginning: each is known by a rare piece, and both
    forms agree."""
    words = [f"prefix-{i:04d}-{'abcdefgh'[i % 8]}" for i in range(5000)]
    t = tx.Taxonomy.from_dict({"c": {f"s{k}": words[k::50] for k in range(50)}, "short": {"x": ["q", "zz"]}})
    by = tx.rarest_pieces(t)
    assert sum(len(v) for v in by.values()) == 5000 and max(len(v) for v in by.values()) < 200 and "pre" not in by
    texts = [" ".join(words[i * 7 % 5000] for i in range(k, k + 9)) for k in range(0, 200, 5)] + ["prefix-", "zz prefix-9999-a", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, title string").withColumn("description", F.lit(None).cast("string"))
    few = tx.Taxonomy(categories=[("c", t.categories[0][1][:4]), t.categories[1]])
    got = {m: {r["k"]: r["categories"] for r in tx.categorise(df, few, method=m).collect()} for m in ("expr", "pieces")}
    assert got["expr"] == got["pieces"]
    whole = {r["k"]: r["categories"] for r in tx.categorise(df, t, method="pieces").collect()}
    for k, text in enumerate(texts):
        held = {f"s{words.index(w) % 50}" for w in (text or "").split() if w in words}
        assert set(whole[k].get("c", [])) == held


def test_pieces_by_their_frequency_in_texts(spark):
    t = tx.Taxonomy.from_dict({"c": {"a": ["reactor"], "b": ["react"], "n": ["no"]}})
    df = spark.createDataFrame([(i, "act react rea", "") for i in range(5)] + [(9, "reactor", "")], "k long, title string, description string")
    frequency = tx.piece_frequencies(df, t, "title")
    assert frequency["rea"] == 6 and frequency["tor"] == 1
    assert [p for p, words in tx.rarest_pieces(t, frequency).items() if ("reactor", 0, 0) in words][0] in ("cto", "tor")
    a = [r["categories"] for r in tx.categorise(df, t, method="pieces", frequency=frequency).orderBy("k").collect()]
    assert a == [r["categories"] for r in tx.categorise(df, t).orderBy("k").collect()]
