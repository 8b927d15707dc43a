"""The pipeline, stage by stage, against brute force on its own input."""

from collections import Counter

import corpus_pipeline as C
from gazette.llm import langid
from gazette.llm.common import prepare, staged
from tests.conftest import SF001
from tests.llm import data as D
from tests.llm.test_models import check_packing


def run_stages(spark, docs):
    out = [docs]
    for name, stage in C.STAGES:
        out.append(staged(stage(spark, out[-1], SF001), f"test-{name}"))
    return out


def rows(df):
    """(doc_id, text, lang, source) of all documents."""
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def check(stages):
    """Each stage's whole output is that of brute force on the stage's input."""
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    docs, known, lines, near, mixed = (rows(df) for df in stages[:-1])
    model = langid.fit(stages[0])
    told = [D.language(d[1], model) for d in docs]
    assert Counter(known) == Counter(d for d, (lang, ambiguous) in zip(docs, told) if lang != "und" and not ambiguous)
    left = [(d[0], text, *d[2:]) for d, (_, _, text) in zip(known, D.kept_lines(known))]
    assert Counter(lines) == Counter(d for d in left if d[1].strip(D.BLANKS))
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())
    assert Counter(d[0] for d in near) == D.distinct(lines) and not Counter(near) - Counter(lines)
    assert Counter(mixed) == Counter(d for d, n in zip(near, D.mix_copies(near)) for _ in range(n))
    check_packing(stages[-1].collect(), [d[:2] for d in mixed])


def test_pipeline_on_a_table(spark):
    prepare(spark)
    check(run_stages(spark, spark.read.parquet(f"{SF001}/documents.parquet")))


def test_pipeline_on_odd_rows(spark):
    prepare(spark)
    stages = run_stages(spark, D.frame(spark))
    check(stages)
    assert stages[-1].count() > 0


def test_pipeline_on_nothing(spark):
    prepare(spark)
    assert [df.count() for df in run_stages(spark, D.empty(spark))] == [0] * 6


def test_run(spark):
    out = C.run(spark, SF001)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert [n for n, _ in C.STAGES] == ["language", "lines", "near_copies", "mixture", "packed"] and C.ORACLE_SQL is None
