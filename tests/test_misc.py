from gazette.session import cluster_conf
from tests.conftest import SF01

def test_cluster_conf():
    c = cluster_conf(100 * 1024 ** 4, cores=8000, executor_memory_gb=16, executor_cores=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 409601
    small = cluster_conf(10 * 1024 ** 2, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16      # at least two waves of tasks


def test_tasks_of_a_rendered_scan_are_bounded(spark, monkeypatch):
    """A table of more rows is dealt out to more tasks."""
    from gazette.operators import partitioning as P
    from gazette.plans import bindings as B
    o = B.table(spark, SF01, "orders").select("o_orderkey")
    assert B.spread(o).rdd.getNumPartitions() == 4
    monkeypatch.setattr(P, "ROWS_A_TASK", 1000)
    parts = [len(p) for p in B.spread(o).rdd.glom().collect()]
    assert len(parts) == 15 and sum(parts) == 15000 and max(parts) < 1500
    assert P.spread_rows(spark.range(0, 100, 1, 6), 1).rdd.getNumPartitions() == 100
    assert P.spread_rows(spark.range(0), 1).count() == 0
