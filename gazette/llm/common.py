"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import apply_engine_conf, ensure_checkpoint_dir, ship_package

# A word is a maximal run of anything but these (space and \t \n \v \f \r).
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_REGEX = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Non-ASCII characters outside this Latin-1 range may be changed by lower().
_MAY_FOLD = r"[^\x00-\u00BF\u00D7\u00DF-\u00FF]"

def prepare(spark: SparkSession) -> None:
    """Session settings and code the operators rely on."""
    apply_engine_conf(spark)
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    values that depend on how rows lay in tasks are fixed for all readers."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` does just that (and fast) unless the text holds a character whose
    case it could change; only then each character is mapped."""
    plain = (F.octet_length(c) == F.char_length(c)) | ~c.rlike(_MAY_FOLD)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_or_empty(docs: DataFrame, column: str = "text") -> Column:
    return F.coalesce(docs[column], F.lit(""))


def word_count(c: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        while w.lower() in taken:
            w = "_" + w
        taken.add(w.lower())
        out.append(w)
    return out
