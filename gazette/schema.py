"""Record schemas: intake records, stored rows, the long-form dictionary and scorer answers."""

from pyspark.sql import types as T

# One normalised intake record. ``ord`` is the input order made explicit at
# ingestion (Spark rows carry no order of their own).
INTAKE = T.StructType([
    T.StructField("ord", T.LongType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("external_id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("posted_date", T.DateType(), True),
    T.StructField("deadline", T.DateType(), True),
    T.StructField("tender_type", T.StringType(), True),
])

INTAKE_COLUMNS = [f.name for f in INTAKE.fields]

# A stored row. Categories are generic (``MAP<category, ARRAY<sub>>``); per
# category flags are derived from the map by the report layer.
STORE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("external_id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("url", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("posted_date", T.DateType(), True),
    T.StructField("deadline", T.DateType(), True),
    T.StructField("first_seen", T.TimestampType(), False),
    T.StructField("last_checked", T.TimestampType(), False),
    T.StructField("categories", T.MapType(T.StringType(), T.ArrayType(T.StringType())), True),
    T.StructField("keyword_hits", T.StringType(), True),
    T.StructField("score", T.DoubleType(), True),
    T.StructField("ai_reason", T.StringType(), True),
    T.StructField("is_research", T.BooleanType(), True),
    T.StructField("tender_type", T.StringType(), True),
])

STORE_COLUMNS = [f.name for f in STORE.fields]

# Long form of the keyword dictionary. ``scope`` is 'category', 'exclude' or
# 'hint'; for hints ``category`` holds the hinted type. ``seq`` keeps the
# dictionary order (category order, then sub order, then keyword order).
TAXONOMY = T.StructType([
    T.StructField("scope", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
    T.StructField("sub", T.StringType(), True),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("seq", T.IntegerType(), False),
])

# A validated scorer answer.
ANSWER = T.StructType([
    T.StructField("score", T.IntegerType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("is_research", T.BooleanType(), True),
    T.StructField("tender_type", T.StringType(), True),
])
