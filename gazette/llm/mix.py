"""Mixing sources to target weights.

Each source gets a share of a word budget by its weight, up to ``max_repeat``
times its own size; what it can't use is shared among the others by weight
until none is above. A source takes whole passes over its documents as long as
they fit, and the rest of its target from the documents of lowest hash: the
threshold is found on histograms. Words are summed by source and hash bucket,
the bucket where the running sum reaches the rest is the boundary, and only the
boundary bucket is refined, by the next bits of the hash, twice more; what then
shares a bucket is a handful of documents, among which the nearest sum decides.
Documents are never sorted or moved: the result is a filter on (source, hash).

A document is taken whole, so a source ends within half the size of the
document on its threshold. The hash depends on doc_id and text only: reruns,
retries and other partitionings agree.

Histograms are pre-aggregated in each task, at most ``BUCKETS`` rows a source,
so a source with a third of all rows weighs no more than another. What is kept
a source is one row; sources are numbered in one task over those rows.

Defined cases: null texts have size 0. A null source is a source of its own and
the last one. Rows alike in doc_id and text share one fate. Without any words
all targets are 0. An empty table gives an empty result, extra columns stay,
columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import free_name, staged, word_count

WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)      # 150 % of all words, as a fraction
MAX_REPEAT = 2
BITS = 60
LEVEL_BITS = 12
LEVELS = 3
BUCKETS = 1 << LEVEL_BITS


def hash60(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 over doc_id and text."""
    said = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> with weight and target.

    Water-filling: in the order of size by weight the sources that stop at
    ``MAX_REPEAT`` sizes come first; the first that doesn't, and all after it,
    share what is left by weight. All sums are whole numbers."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1)
    s = sizes.withColumn("weight", weight.cast("long"))
    num, den = BUDGET
    fill = W.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    s = s.withColumns({
        "before": F.coalesce(F.sum("source_size").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing)),
        "place": F.row_number().over(fill), "total": F.sum("source_size").over(whole)})
    # what a unit of weight gets if all before this source stop and none from it on does
    unit = (F.col("total") * num - F.col("before") * MAX_REPEAT * den) / (F.col("open") * den)
    s = s.withColumn("unit", unit)
    s = s.withColumn("first", F.min(F.when(F.col("unit") * F.col("weight") <= F.col("source_size") * MAX_REPEAT, F.col("place"))).over(whole))
    s = s.withColumn("level", F.max(F.when(F.col("place") == F.col("first"), F.col("unit"))).over(whole))
    stops = F.col("first").isNull() | (F.col("place") < F.col("first"))
    target = F.when(stops, (F.col("source_size") * MAX_REPEAT).cast("double")).otherwise(F.col("level") * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (= copies x
    size, the words that the mix takes of the document)."""
    names = ("size", "source_size", "target", "copies", "taken")
    h, = free_name(docs, "h")
    given = [c for c in docs.columns if c.lower() not in names]
    sized = docs.select(*[docs[f"`{c}`"] for c in given], word_count(docs[text]).alias("size"), hash60(docs["doc_id"], docs[text]).alias(h))
    found = thresholds(sized.select(sized[source].alias("source"), F.col(h).alias("h"), "size"))
    out = sized.join(found, sized[source].eqNullSafe(found["src"]), "left")
    copies = out["passes"] + F.when(out[h] < out["threshold"], 1).otherwise(0)
    return out.select(*[sized[f"`{c}`"] for c in given], sized["size"], found["source_size"], found["target"],
                      copies.cast("long").alias("copies"), (copies * sized["size"]).cast("long").alias("taken"))


def thresholds(rows: DataFrame) -> DataFrame:
    """(source, h, size) -> (src, source_size, target, passes, threshold):
    every document is taken ``passes`` times, and once more if h < threshold."""
    rows = staged(rows, "mix-sizes")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("passes", passes.cast("long")).select(
        F.col("source").alias("src"), "source_size", "target", "passes",
        (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"))
    plan = staged(plan, "mix-targets")
    at = plan.where(F.col("rest") > 0).select("src", "rest", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("below"))
    for level in range(1, LEVELS + 1):
        at = refined(rows, at, BITS - LEVEL_BITS * level)
    # the few documents left in the boundary bucket, by hash
    last = inside(rows, at, BITS - LEVEL_BITS * LEVELS).groupBy("src", "rest", "below", "h").agg(F.sum("size").alias("size"))
    upto = F.col("below") + F.sum("size").over(W.partitionBy("src").orderBy("h"))
    last = last.withColumn("upto", upto).where(F.col("upto") >= F.col("rest"))
    nearer = F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("size"))
    cut = last.groupBy("src").agg(F.min_by(F.when(nearer, F.col("h") + 1).otherwise(F.col("h")), "h").alias("threshold"))
    cut = cut.select(F.col("src").alias("cut_src"), "threshold")
    got = plan.join(cut, plan["src"].eqNullSafe(cut["cut_src"]), "left")
    return staged(got.select("src", "source_size", "target", "passes", F.coalesce("threshold", F.lit(0)).cast("long").alias("threshold")), "mix-plan")


def inside(rows: DataFrame, at: DataFrame, shift: int) -> DataFrame:
    """The rows in the boundary bucket of their source."""
    same = rows["source"].eqNullSafe(at["src"]) & (F.shiftright(rows["h"], shift) == at["bucket"])
    return rows.join(at, same).select("src", "rest", "below", "h", "size")


def refined(rows: DataFrame, at: DataFrame, shift: int) -> DataFrame:
    """One level down: sum the boundary bucket of each source by the next bits
    of the hash and find the part in which the running sum reaches the rest."""
    sums = (inside(rows, at, shift + LEVEL_BITS).groupBy("src", "rest", "below", F.shiftright("h", shift).alias("part"))
            .agg(F.sum("size").alias("size")))
    upto = F.col("below") + F.sum("size").over(W.partitionBy("src").orderBy("part"))
    reach = sums.withColumn("upto", upto).where(F.col("upto") >= F.col("rest"))
    first = F.min_by(F.struct("rest", F.col("part").alias("bucket"), (F.col("upto") - F.col("size")).alias("below")), "part")
    return staged(reach.groupBy("src").agg(first.alias("b")).select("src", "b.*"), "mix-boundary")
