"""Bindings of the operators to the driver's tables.

The operators are general; each query binds one to a table of the test data.
Everything here is derived from the tables by Spark, so the work grows with
them. Two virtual tables are used throughout:

* ``N`` — intake records from ``documents``: ``ord = doc_id``; title = first
  line of the text (stripped); description = the whole text; url from a key
  that repeats (``doc_id`` when divisible by 3, else ``doc_id % 100``), so one
  batch holds repeated, updated and new urls.
* ``T`` — stored rows from ``orders``: ``id = o_orderkey``; dates from the
  order date; score, type and category flags from the key.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import ts_lit

from .. import constants as K
from ..functions.text import unicode_strip
from ..operators.partitioning import spread_rows, spread_scan
from ..operators.taxonomy import Taxonomy

AS_OF = _dt.date(1998, 6, 1)
RUN_TS = _dt.datetime(1998, 6, 1, 0, 0, 0)
STORE_TS = _dt.datetime(1998, 5, 1, 0, 0, 0)
SINCE = _dt.date(1997, 1, 1)

# Our own test dictionary (Latin-script fragments that occur in the
# generated prose). One keyword is written decomposed (NFD) and one in upper
# case to exercise the normaliser.
TEST_DICTIONARY = {
    "grid": {
        "lines": ["thwh", "whwh"],
        "storage": ["eauaux", "eaueau"],
    },
    "reactor": {
        "licensing": ["MIT License", "license"],
        "materials": ["ererer", "mentment", "ungung"],
        "fusion": ["token"],
    },
    "radiation": {
        "dosimetry": ["ñ", "ción"],
        "shielding": ["ß", "chch"],
    },
    "exclude": ["$$$", "%%%"],
    "tender_type_hints": {
        "subsidy": ["iter", "ouai"],
        "commissioned": ["ev", "stst"],
    },
}

# Sources of N are the documents' source names.
DOC_SOURCE_PATTERN = r"^src[0-9]+$"

# category -> display label (tabs, tags)
CATEGORY_LABELS = {"grid": "Grid", "reactor": "Reactor", "radiation": "Radiation"}


def taxonomy() -> Taxonomy:
    return Taxonomy.from_dict(TEST_DICTIONARY)


TEXT_TABLES = ("documents", "pages")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = raw_table(spark, sf_dir, name)
    return spread_scan(df) if name in TEXT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """A plain scan dealt out to tasks of bounded size, ahead of rendering and
    parsing."""
    return spread_rows(df)


# --------------------------------------------------------------------------
# N: intake records from documents


def doc_url_key() -> F.Column:
    d = F.col("doc_id")
    return F.when(d % 3 == 0, d).otherwise(d % 100)


def documents_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    first_line = F.regexp_extract(F.col("text"), r"^[^\n]*", 0)
    posted = F.date_add(F.lit(_dt.date(1997, 1, 1)), (F.col("doc_id") % 500).cast("int"))
    return d.select(
        F.col("doc_id").alias("ord"),
        F.col("source"),
        F.col("doc_id").cast("string").alias("external_id"),
        unicode_strip(first_line).alias("title"),
        F.concat(F.lit("https://d.example/"), doc_url_key().cast("string")).alias("url"),
        F.col("text").alias("description"),
        posted.alias("posted_date"),
        F.when(F.col("doc_id") % 11 != 0,
               F.date_add(posted, (30 + F.col("doc_id") % 60).cast("int"))).alias("deadline"),
        F.lit(K.UNKNOWN).alias("tender_type"),
    )


def split_point(spark: SparkSession, sf_dir: str):
    """First doc_id of the batch half: store = doc_id below it, batch = the rest."""
    return raw_table(spark, sf_dir, "documents").select(
        F.floor((F.max("doc_id") + 1) / 2).cast("long")).scalar()


# --------------------------------------------------------------------------
# T: stored rows from orders


def orders_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    posted = F.to_date("o_orderdate")
    ttype = (F.when(k % 13 == 0, F.lit(None).cast("string"))
             .when(F.col("o_orderstatus") == "F", F.lit("subsidy"))
             .when(F.col("o_orderstatus") == "O", F.lit("commissioned"))
             .otherwise(F.lit(K.UNKNOWN)))
    cats = F.map_from_entries(F.filter(F.array(
        F.when(k % 2 == 0, F.struct(F.lit("grid").alias("key"), F.array(F.lit("lines")).alias("value"))),
        F.when(k % 3 == 0, F.struct(F.lit("reactor").alias("key"), F.array(F.lit("fusion")).alias("value"))),
        F.when(k % 5 == 0, F.struct(F.lit("radiation").alias("key"), F.array(F.lit("shielding")).alias("value"))),
    ), lambda e: e.isNotNull()))
    return o.select(
        k.alias("id"),
        F.lit("mext").alias("source"),
        k.cast("string").alias("external_id"),
        F.concat(F.col("o_orderpriority"), F.lit(" order "), k.cast("string")).alias("title"),
        F.concat(F.lit("https://n.example/"), k.cast("string")).alias("url"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string"), F.lit(" status "),
                 F.col("o_orderstatus")).alias("description"),
        F.when(k % 19 != 0, posted).alias("posted_date"),
        F.when(k % 17 != 0, F.date_add(posted, 30)).alias("deadline"),
        ts_lit(STORE_TS).alias("first_seen"),
        ts_lit(STORE_TS).alias("last_checked"),
        cats.alias("categories"),
        F.lit(None).cast("string").alias("keyword_hits"),
        F.when(k % 7 != 0, (k % 11).cast("double")).alias("score"),
        F.when(k % 7 != 0, F.concat(F.lit("reason "), (k % 11).cast("string"))).alias("ai_reason"),
        F.when(k % 7 != 0, k % 4 == 0).alias("is_research"),
        ttype.alias("tender_type"),
    )
