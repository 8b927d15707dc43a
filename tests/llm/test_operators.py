"""Every operator on odd rows, against brute force."""

import pytest

from gazette.llm import jaccard, linededup, mix, quality, substring, suffixdedup
from gazette.llm.common import prepare
from tests.llm import data as D


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return D.frame(spark).repartition(3).cache()


def got(df, *cols):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


def same(df, cols, expected):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert got(df, *cols) == sorted(expected, key=key)


def test_line_dedup(docs):
    from pyspark.sql import functions as F
    out = linededup.line_dedup(docs).withColumn("sha", F.sha2("text", 256))
    same(out, ["doc_id", "n_lines", "n_dropped", "sha"], D.line_dedup(D.texts()))
    assert {"h", "th", "lines", "keep", "drop"} <= set(out.columns)
    assert {r["keep"] for r in out.select("keep").collect()} == {f"x{D.CLASHES.index('keep')}"}


def test_line_dedup_many_lines_in_few_documents(spark):
    given = [(i, "\n".join([f"This is the common line number {k}." for k in range(50)] * 2), "en", "s") for i in range(4)]
    from pyspark.sql import functions as F
    out = linededup.line_dedup(D.frame(spark, given)).withColumn("sha", F.sha2("text", 256))
    same(out, ["doc_id", "n_lines", "n_dropped", "sha"], D.line_dedup(given))


def test_suffix_dedup(docs):
    same(suffixdedup.suffix_dedup(docs), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], D.suffix_dedup(D.texts()))


def test_suffix_dedup_with_frequent_tokens(spark, monkeypatch):
    """A line so frequent that several splitters fall on its leading tokens."""
    prepare(spark)
    monkeypatch.setattr(suffixdedup, "SUFFIXES_A_RANGE", 4)
    found = []
    real = suffixdedup.sample_splitters
    monkeypatch.setattr(suffixdedup, "sample_splitters", lambda *a: found.append(real(*a)) or found[-1])
    line = "All of the documents share this line of some more than fifty bytes."
    given = [(i, f"{D.sentence(i, 12)}\n{line}\n{D.sentence(1000 + i, 12)}", "en", "s") for i in range(80)]
    docs = D.frame(spark, given).repartition(3)
    same(suffixdedup.suffix_dedup(docs), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], D.suffix_dedup(given))
    assert (found[0][1:] == found[0][:-1]).any()


def test_substring_dedup(docs):
    same(substring.substring_dedup(docs), ["doc_id", "n_words", "n_removed", "kept_sha256"], D.substring_dedup(D.texts()))


def test_jaccard_join(docs):
    same(jaccard.jaccard_join(docs), ["doc_id", "n_shingles", "component_id"], D.jaccard(D.texts()))


def near_group(n=60):
    """One large group of near-copies, each with a few words changed, and some
    that are near only to some of the others."""
    base = D.sentence(77, 150).split(" ")
    out = []
    for i in range(n):
        w = list(base)
        for k in range(i % 7):
            w[(i * 13 + k * 29) % 150] = f"z{i}"
        out.append((i, " ".join(w), "en", "s"))
    return out + [(100 + i, D.sentence(500 + i, 100), "en", "s") for i in range(10)]


@pytest.mark.parametrize("block", [700, 500_000])
def test_jaccard_join_in_blocks(spark, monkeypatch, block):
    prepare(spark)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    given = near_group()
    same(jaccard.jaccard_join(D.frame(spark, given)), ["doc_id", "n_shingles", "component_id"], D.jaccard(given))


def test_distinct_documents(docs):
    out = jaccard.distinct_documents(docs)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    expected = D.jaccard(D.texts())
    groups = {c for _, n, c in expected if n}
    assert sorted(i for i, t in kept if D.shingles(t)) == sorted(groups)
    assert sum(1 for _, t in kept if not D.shingles(t)) == sum(1 for _, n, _ in expected if not n)


def test_mix(docs):
    out = mix.mix(docs).select("doc_id", "text", "source", "size", "source_size", "target", "taken", "copies").collect()
    size, source, total, target = D.mix(D.texts())
    assert sorted(r["size"] for r in out) == sorted(size)
    for r in out:
        assert r["source_size"] == total[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    for s in total:
        of = [r for r in out if r["source"] == s]
        # repeated rows share one fate, so the threshold may fall on both of them
        assert abs(sum(r["taken"] for r in of) - target[s]) <= 2 * max(r["size"] for r in of) / 2 + 1e-6
    fate = lambda rs: sorted((str(r["doc_id"]), str(r["text"]), r["taken"]) for r in rs)
    assert fate(mix.mix(docs.repartition(5)).collect()) == fate(out)


def test_quality(docs):
    out = {(r["doc_id"], r["text"]): r for r in quality.quality(docs).collect()}
    for i, t, *_ in D.texts():
        r, w = out[i, t], D.words(t)
        win = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        again = {p for k, x in enumerate(win) if win.count(x) > 1 for p in range(k, k + 5)} if len(win) < 2000 else set()
        lines = [x for x in (t or "").split("\n") if D.words(x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        if len(win) < 2000:
            assert r["n_repeat_words"] == len(again), (i, t)
        assert r["base_failed"] == (len(w) < 10 or 100 * r["n_repeat_words"] > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert "Home" not in out[27, dict((i, t) for i, t, *_ in D.texts())[27]]["clean_text"]


def test_quality_rejects_lines(spark):
    clean = ". ".join(D.sentence(i, 12) for i in range(6)) + "."
    nav = "Home | About us | Contact | Login | Search"
    given = [(1, clean, "en", "s"), (2, clean + "\n" + nav, "en", "s"), (3, "\n".join([nav + str(i) for i in range(9)]), "en", "s"),
             (4, " ".join(x + "###" for x in D.sentence(5, 60).split()), "en", "s"), (5, D.sentence(8, 60) + "\nAll Rights Reserved by us today.", "en", "s")]
    kept = {r["doc_id"]: r for r in quality.quality(D.frame(spark, given)).collect()}
    assert {i for i in kept if kept[i]["kept"]} == {1, 2, 5}
    assert kept[2]["clean_text"] == clean and "Rights" not in kept[5]["clean_text"]


def test_empty_tables(spark):
    prepare(spark)
    none = D.empty(spark)
    for run in (linededup.line_dedup, suffixdedup.suffix_dedup, substring.substring_dedup, jaccard.jaccard_join, jaccard.distinct_documents, mix.mix, quality.quality):
        assert run(none).collect() == []


def test_no_more_buckets_than_spark_allows(spark, monkeypatch):
    """Beyond the limit a bucket holds more chunks; results are the same."""
    from gazette.llm import chunks
    prepare(spark)
    docs = D.frame(spark)
    expected = sorted(map(str, substring.substring_dedup(docs).collect()))
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 2000)
    assert chunks.stage(docs.coalesce(1)).table.select("chunk").distinct().count() > 5   # several chunks a task
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        assert sorted(map(str, substring.substring_dedup(docs).collect())) == expected
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("chunks_")]


def test_ranges_are_met_in_steps_of_the_keys():
    """However many ranges there are, a chunk's requests take as many steps as
    it has keys, and every key is in its range."""
    import numpy as np
    from gazette.llm import chunks
    keys = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 500, dtype=np.uint64, endpoint=False))
    keys = np.unique(np.concatenate([keys, np.array([0, 2 ** 64 - 1], np.uint64)]))
    for n in (1, 7, 1000, 10_000, 2 ** 31 - 1):
        parts, begin, end = chunks.ranges_met(keys, n)
        assert len(parts) <= len(keys) and (np.diff(parts) > 0).all() and begin[0] == 0 and end[-1] == len(keys)
        assert all(int(k) * n >> 64 == p for p, b, e in zip(parts, begin, end) for k in keys[b:e])
        asked = chunks.requests(3, keys, n)
        assert asked.num_rows == len(parts) and sum(len(k.as_py()) for k in asked.column("keys")) == 8 * len(keys)
    assert chunks.requests(3, keys[:0], 100).num_rows == 0


def test_splitters_grow_with_the_suffixes(spark, monkeypatch):
    """Ten times the copies: ten times the ranges, none of them much larger."""
    import numpy as np
    from gazette.llm import chunks
    prepare(spark)
    monkeypatch.setattr(suffixdedup, "SUFFIXES_A_RANGE", 100)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 4000)
    sizes = {}
    real = suffixdedup.sample_splitters
    for copies in (20, 200):
        got = []
        monkeypatch.setattr(suffixdedup, "sample_splitters", lambda *a: got.append((real(*a), a[3])) or got[-1][0])
        given = [(i, D.sentence(i % copies, 60), "en", "s") for i in range(2 * copies)]
        docs = D.frame(spark, given).repartition(4)
        same(suffixdedup.suffix_dedup(docs), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], D.suffix_dedup(given))
        splitters, n = got[0]
        leads = np.array([int.from_bytes((t[k:k + 8]).encode(), "big") for _, t, *_ in given for k in range(0, len(t) - 8, 17)], np.uint64)
        sizes[copies] = (n, np.bincount(np.searchsorted(splitters, leads, "right"), minlength=n).max() / len(leads) * n)
        assert len(splitters) == n - 1
    assert sizes[200][0] >= 8 * sizes[20][0] and sizes[200][1] < 8
