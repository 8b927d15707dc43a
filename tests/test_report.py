import datetime as dt

from pyspark.sql import Window, functions as F

from gazette.functions import dates as D
from gazette.operators import report as R
from gazette.operators.ordering import global_rank

AS_OF = dt.date(2024, 6, 1)


def store(spark):
    rows = [
        (1, dt.date(2024, 5, 31), 9.0, "commissioned", None),   # past deadline
        (2, dt.date(2024, 6, 10), 4.0, "commissioned", None),   # score < 5
        (3, dt.date(2024, 6, 10), None, "commissioned", None),  # not scored
        (4, dt.date(2024, 6, 10), 9.0, "subsidy", None),        # subsidy
        (5, dt.date(2024, 6, 10), 6.0, "unknown", dt.date(2024, 1, 5)),
        (6, dt.date(2024, 6, 10), 6.0, None, dt.date(2024, 1, 20)),
        (7, None, 8.0, "commissioned", dt.date(2023, 12, 1)),
        (8, dt.date(2024, 6, 1), 5.0, "commissioned", None),
    ]
    df = spark.createDataFrame(rows, "id long, deadline date, score double, tender_type string, posted_date date")
    return df.withColumn("categories", F.when(F.col("id") % 2 == 0, F.create_map(F.lit("grid"), F.array(F.lit("x"))))
                         .otherwise(F.create_map(F.lit("nuclear"), F.array(F.lit("y"))))) \
             .withColumn("title", F.concat(F.lit("<t> "), F.col("id").cast("string")))


def test_active_board_rules_and_order(spark):
    b = R.active_board(store(spark), AS_OF, ["grid", "nuclear"], {"grid": "Grid", "nuclear": "Nuclear"})
    got = [r["id"] for r in b.orderBy("board_rank").collect()]
    # deadline asc, NULL last; same deadline: score desc, then id desc
    assert got == [8, 6, 5, 7]
    assert [r["board_rank"] for r in b.orderBy("board_rank").collect()] == [1, 2, 3, 4]


def test_tabs_and_counts(spark):
    b = R.active_board(store(spark), AS_OF, ["grid", "nuclear"], {"grid": "Grid", "nuclear": "Nuclear"})
    c = R.tab_counts(b, ["grid", "nuclear"]).first()
    assert (c["n_all"], c["n_grid"], c["n_nuclear"]) == (4, 2, 2)
    tabs = sorted((r["tab"], r["id"]) for r in R.tab_rows(b, ["grid", "nuclear"]).collect())
    assert tabs == [("grid", 6), ("grid", 8), ("nuclear", 5), ("nuclear", 7)]


def test_badges_and_bands(spark):
    df = spark.createDataFrame([(d,) for d in [None, dt.date(2024, 5, 31), dt.date(2024, 6, 1), dt.date(2024, 6, 2),
                                               dt.date(2024, 6, 8), dt.date(2024, 6, 9)]], "d date")
    got = [r[0] for r in df.select(D.deadline_badge("d", AS_OF)).collect()]
    assert got == [None, "期限切れ", "本日期限", "あと 1 日", "あと 7 日", "06/09 まで"]
    s = spark.createDataFrame([(x,) for x in [None, 8.0, 5.0, 4.9]], "s double")
    assert [r[0] for r in s.select(D.score_band("s")).collect()] == ["none", "high", "mid", "low"]


def test_archive_order_and_months(spark):
    a = R.archive(store(spark), dt.datetime(2024, 6, 1, 12, 30))
    rows = a.orderBy("archive_rank").collect()
    assert [r["id"] for r in rows][:3] == [6, 5, 7]
    assert rows[0]["month_label"] == "2024年01月" and rows[0]["month_rank"] == 1
    assert rows[-1]["month_label"] == "不明"          # unknown month last
    assert rows[0]["generated_at"] == "2024-06-01 12:30 UTC"
    assert rows[0]["title_html"].startswith("&lt;t&gt;")
    m = {r["month_label"]: r for r in R.month_counts(store(spark)).collect()}
    assert m["2024年01月"]["month_count"] == 2 and m["不明"]["month_rank"] == 3
    assert m["不明"]["total_count"] == 8


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13).alias("g"))
    ranked = global_rank(df, [F.col("g").desc(), F.col("k")], out="r", partitions=7)
    expect = df.withColumn("r", F.row_number().over(Window.orderBy(F.col("g").desc(), F.col("k"))))
    assert ranked.select("k", "g", "r").exceptAll(expect.select("k", "g", "r")).count() == 0


def test_publish(spark, tmpdir_path):
    b = R.active_board(store(spark), AS_OF, ["grid", "nuclear"], {"grid": "Grid", "nuclear": "Nuclear"})
    a = R.archive(store(spark), dt.datetime(2024, 6, 1))
    paths = R.publish(b, a, tmpdir_path)
    assert spark.read.parquet(paths["board"]).count() == 4
    assert spark.read.parquet(paths["archive"]).select("month_label").distinct().count() == 3


def test_global_rank_balanced_under_a_hot_key(spark):
    # a third of the rows share one deadline: the range partitioning runs on the
    # full (unique) sort key, so the hot value is split across partitions
    n = 30000
    df = spark.range(n).select(F.col("id"),
                               F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997).alias("dl"))
    order = [F.col("dl").asc(), F.col("id").desc()]
    sizes = [r[1] for r in df.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * n / 8
    ranked = global_rank(df, order, out="r", partitions=8)
    expect = df.withColumn("r", F.row_number().over(Window.orderBy(*order)))
    assert ranked.select("id", "r").exceptAll(expect.select("id", "r")).count() == 0
