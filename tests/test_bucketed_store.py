import os

from pyspark.sql import functions as F

from gazette.operators import store as ST
from gazette.operators import taxonomy as tx
from gazette.plans import bindings as B
from tests.conftest import SF001


def test_bucketed_store_join_shuffles_only_the_batch(spark, tmpdir_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # force the shuffle join shape
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = B.documents_intake(spark, SF001)
        kept = tx.prepare(n, B.taxonomy()).filter("stage = 'kept'").withColumn("tender_type", F.col("pre_label"))
        half = B.split_point(spark, SF001)
        first = ST.upsert(ST.empty_store(spark), ST.fold_batch(kept.filter(F.col("ord") < half)), B.STORE_TS)
        table = "store_v0_" + os.path.basename(tmpdir_path).replace("-", "_")
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        ST.write_store_table(first, table, 8)
        store = ST.read_store_table(spark, table)
        merged = ST.upsert(store, ST.fold_batch(kept.filter(F.col("ord") >= half)), B.RUN_TS, checkpoint=False)
        join_plan = merged._jdf.queryExecution().executedPlan().toString()
        # one exchange for the folded batch (and its partial aggregate), none over the store scan
        scan_line = [ln for ln in join_plan.split("\n") if "FileScan parquet" in ln and table in ln]
        assert scan_line and "SelectedBucketsCount: 8 out of 8" in join_plan
        store_branch = join_plan.split(scan_line[0])[0].split("\n")[-2]
        assert "Exchange" not in store_branch
        assert merged.count() == first.count() + merged.filter(F.col("first_seen") == F.lit(B.RUN_TS)).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
