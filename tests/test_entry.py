import importlib
import os
import subprocess
import sys

from tests.conftest import SF001


def test_contract(spark):
    E = importlib.import_module("__spark_entry__")
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:2] == ["board_rank", "id"]


def test_every_query_plans_on_smoke_data(spark):
    E = importlib.import_module("__spark_entry__")
    for name, fn in E.queries().items():
        df = fn(spark, SF001)
        assert len(df.columns) > 0, name


def test_oracle_sql_parses():
    import duckdb
    E = importlib.import_module("__spark_entry__")
    con = duckdb.connect()
    for t in ("orders", "documents", "pages", "embeddings", "benchmark", "labels", "conversations", "customer", "lineitem", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.sql(f"EXPLAIN {sql}")


def test_entry_without_the_corpus_subpackage(monkeypatch):
    """The other queries are there when the subpackage is not."""
    E = importlib.import_module("__spark_entry__")
    monkeypatch.setitem(sys.modules, "gazette.llm.queries", None)
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 50 and not [n for n in q if n.startswith("op") or n == "pipeline"] and set(o) <= set(q)


def test_python_workers_find_the_package_from_another_folder(tmp_path):
    """Queries with Python functions run when started elsewhere with the
    repository on sys.path of the driver only."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
            "import __spark_entry__ as E\n"
            f"print('ROWS', E.queries()['definition_fields'](spark, {SF001!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1500" in out.stdout, out.stderr[-2000:]
