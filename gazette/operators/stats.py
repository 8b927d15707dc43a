"""Run counters (D3, D9) and the uncategorised sample.

All counters come from one aggregate over a ``stage`` column (the exclusive
first-match funnel excluded -> no_category -> kept) plus one over the scorer
outcomes, so the run is counted without collecting rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K


def run_stats(prepared: DataFrame, answers: DataFrame | None, fetched_total: DataFrame | None = None,
              cap: int | None = None, source_failures: int = 0, skip_ai: bool = False,
              rejected: DataFrame | None = None, source_rejected: DataFrame | None = None) -> DataFrame:
    """One row: fetched, truncated_to, excluded, no_category, upserted, the
    three label counts, ai_classified, ai_skipped, failed, exit_status.

    The prepared records, the scorer answers and the fetched records are
    tagged and unioned, then counted in a single aggregate (one job, partial
    aggregation, no joins). ``rejected`` are the records that failed
    validation: they count as failed, and as fetched unless ``fetched_total``
    is given, so fetched = excluded + no_category + upserted + rejected.
    ``source_rejected`` never became records: they count as fetched and failed
    in any case, but not against the cap."""
    parts = [prepared.select(F.lit("p").alias("_k"), "stage", "pre_label", F.lit(None).cast("boolean").alias("ok"))]
    if answers is not None and not skip_ai:
        parts.append(answers.select(F.lit("a").alias("_k"), F.lit(None).cast("string").alias("stage"),
                                    F.lit(None).cast("string").alias("pre_label"), "ok"))
    if fetched_total is not None:
        parts.append(fetched_total.select(F.lit("f").alias("_k"), F.lit(None).cast("string").alias("stage"),
                                          F.lit(None).cast("string").alias("pre_label"),
                                          F.lit(None).cast("boolean").alias("ok")))
    if rejected is not None:
        parts.append(rejected.select(F.lit("r").alias("_k"), F.lit(None).cast("string").alias("stage"),
                                     F.lit(None).cast("string").alias("pre_label"),
                                     F.lit(None).cast("boolean").alias("ok")))
    if source_rejected is not None:
        parts.append(source_rejected.select(F.lit("s").alias("_k"), F.lit(None).cast("string").alias("stage"),
                                            F.lit(None).cast("string").alias("pre_label"),
                                            F.lit(None).cast("boolean").alias("ok")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    k, s = F.col("_k"), F.col("stage")
    kept = (k == "p") & (s == "kept")
    c = u.agg(
        F.count_if(k == "f" if fetched_total is not None else k.isin("p", "r")).alias("_records"),
        F.count_if(k == "r").alias("_rejected"), F.count_if(k == "s").alias("_unread"),
        F.count_if((k == "p") & (s == "excluded")).alias("excluded"),
        F.count_if((k == "p") & (s == "no_category")).alias("no_category"),
        F.count_if(kept).alias("upserted"),
        F.count_if(kept & (F.col("pre_label") == "subsidy")).alias("subsidy_pre_labeled"),
        F.count_if(kept & (F.col("pre_label") == "commissioned")).alias("commissioned_pre_labeled"),
        F.count_if(kept & (F.col("pre_label") == K.UNKNOWN)).alias("unknown_pre_labeled"),
        F.count_if((k == "a") & F.col("ok")).alias("ai_classified"),
        F.count_if((k == "a") & ~F.col("ok")).alias("_bad"),
    )
    failed = F.col("_bad") + F.col("_rejected") + F.col("_unread") + F.lit(source_failures)
    trunc = F.when(F.col("_records") > F.lit(cap), F.lit(cap)) if cap is not None else F.lit(None)
    return c.select(
        (F.col("_records") + F.col("_unread")).cast("long").alias("fetched"), trunc.cast("long").alias("truncated_to"),
        *[F.col(x).cast("long").alias(x) for x in ("excluded", "no_category", "upserted",
                                                    "subsidy_pre_labeled", "commissioned_pre_labeled",
                                                    "unknown_pre_labeled", "ai_classified")],
        (F.col("upserted") if skip_ai else F.lit(0)).cast("long").alias("ai_skipped"),
        failed.cast("long").alias("failed"),
        F.when(failed > 0, F.lit(1)).otherwise(F.lit(0)).alias("exit_status"),
    )


def uncategorised_sample(prepared: DataFrame, n: int = K.UNCATEGORISED_SAMPLE_ROWS,
                         chars: int = K.UNCATEGORISED_SAMPLE_CHARS) -> DataFrame:
    """First ``n`` uncategorised titles in input order, cut to ``chars``."""
    return (prepared.filter(F.col("stage") == "no_category").orderBy("ord").limit(n)
            .select("ord", F.substring("title", 1, chars).alias("sample")))
