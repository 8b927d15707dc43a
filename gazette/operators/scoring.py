"""Scoring: run a caller-supplied scorer over rows, validate its answers in
columns, merge valid answers back into the store.

The scorer is the one per-row remote call of the workload. It runs inside
``mapInPandas`` over Arrow batches: the caller's factory is called once per
task (client setup), then maps a pandas frame ``(key, title, description,
prompt)`` to ``(key, raw, error)``. ``raw`` is the answer as JSON text. A
failure is reported per row, never for the whole task.

Answer validation is pure SQL over VARIANT (``try_parse_json``): integral
scores 0..10 given as number, numeric string or boolean; a reason that is a
JSON string of at most 200 characters; a boolean given as true/false, 0/1 or
the usual words; the type from its enum — a missing or unknown type falls back
to 'unknown' when everything else is valid.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from typing import Callable

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import constants as K
from ..functions.text import prompt_from_safe, sanitise
from ..sources.files import file_system

SCORED = T.StructType([T.StructField("raw", T.StringType()), T.StructField("scorer_error", T.StringType())])

TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")
SCORE_FIELD = "energy_system_score"


ROWS_A_TASK = 500   # rows that one task asks for, while there are few tasks a core
TASKS_A_CORE = 8    # beyond these a task asks for more rows ...
MOST_ROWS = 20_000  # ... up to so many
ROWS_A_NOTE = 50    # rows whose answers are noted together


def score_rows(df: DataFrame, scorer_factory: Callable, key: str = "id",
               title: str = "title", description: str = "description", partitions: int | None = None,
               ledger: str | None = None) -> DataFrame:
    """``(key, raw, scorer_error)`` for every row of ``df`` (J1), asked in
    ``partitions`` tasks (by default one for ``ROWS_A_TASK`` rows, for which
    ``df`` is counted; of very many rows ``tasks_for`` tasks).

    Only the key and the sanitised, bounded scorer inputs (title <= 300,
    description <= 800 code points, the prompt) travel to Python; callers
    merge the keyed answers with ``merge_scores``.

    ``ledger`` is a folder that all executors reach, one a run. Answers are
    noted there before they are handed on, so a task that is tried again
    asks only for the rows it has no answers to. Rows are dealt to tasks by
    their key: whoever runs a task, it has the same rows and the same notes."""
    safe = df.select(
        F.col(key).alias("_key"),
        sanitise(title, K.SCORER_TITLE_CHARS).alias("_title"),
        sanitise(description, K.SCORER_DESCRIPTION_CHARS).alias("_description"),
    )
    n = partitions or tasks_for(df.count(), df.sparkSession.sparkContext.defaultParallelism)
    inputs = safe.select("*", prompt_from_safe("_title", "_description").alias("_prompt")).repartition(n, "_key")
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)] + SCORED.fields)

    def run(batches):
        scorer = scorer_factory()
        notes = Notes(ledger, TaskContext.get().partitionId()) if ledger else None
        for pdf in batches:
            if notes is None:
                raw, error = _asked(scorer, pdf)
            else:
                new = pdf[[str(k) not in notes.answers for k in pdf["_key"]]]
                for at in range(0, len(new), ROWS_A_NOTE):
                    some = new.iloc[at:at + ROWS_A_NOTE]
                    notes.add([str(k) for k in some["_key"]], *_asked(scorer, some))
                raw, error = zip(*[notes.answers[str(k)] for k in pdf["_key"]]) if len(pdf) else ([], [])
            yield pd.DataFrame({key: pdf["_key"].values, "raw": list(raw), "scorer_error": list(error)})
    return inputs.mapInPandas(run, schema)


def tasks_for(rows: int, cores: int) -> int:
    """A task for ``ROWS_A_TASK`` rows. More than ``TASKS_A_CORE`` a core gain
    nothing, since a task that is tried again has its answers noted; tasks then
    grow, to ``MOST_ROWS`` rows at most."""
    return max(1, min(-(-rows // ROWS_A_TASK), max(TASKS_A_CORE * cores, -(-rows // MOST_ROWS))))


class Notes:
    """What the scorer has answered to the rows of one task, kept in files of a
    shared folder (a file for ``ROWS_A_NOTE`` rows; it appears whole or not at all)."""

    def __init__(self, folder: str, task: int):
        self.fs, base = file_system(folder)
        self.place, self.answers = f"{base}/task={task}", {}
        self.fs.create_dir(self.place, recursive=True)
        for f in self.fs.get_file_info(pafs.FileSelector(self.place)):
            if f.base_name.endswith(".json"):
                with self.fs.open_input_stream(f.path) as stream:
                    self.answers |= {k: (r, e) for k, r, e in json.loads(stream.read())}

    def add(self, keys: list, raw: list, error: list) -> None:
        rows = [[k, None if pd.isna(r) else r, None if pd.isna(e) else e] for k, r, e in zip(keys, raw, error)]
        draft = f"{self.place}/{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as stream:
            stream.write(json.dumps(rows).encode())
        self.fs.move(draft, draft + ".json")
        self.answers |= {k: (r, e) for k, r, e in rows}


def _asked(scorer, pdf: pd.DataFrame) -> tuple:
    """Answers and errors of all rows; where a call fails, of each by itself."""
    try:
        return _called(scorer, pdf)
    except Exception:  # find the rows that fail, the others go on
        raw, error = [], []
        for i in range(len(pdf)):
            try:
                r, e = _called(scorer, pdf.iloc[i:i + 1])
            except Exception as exc:  # noqa: BLE001 - reported with its row
                r, e = [None], [f"{type(exc).__name__}: {exc}"]
            raw += r
            error += e
        return raw, error


def _called(scorer, pdf: pd.DataFrame) -> tuple:
    res = scorer(pdf)
    raw, error = list(res["raw"]), list(res["error"])
    if len(raw) != len(pdf) or len(error) != len(pdf):
        raise ValueError(f"{len(raw)} answers to {len(pdf)} rows")
    return raw, error


def rule_scorer_factory():
    """A deterministic scorer for tests and benchmarks (no network).

    From the sanitised title length ``lt`` and description length ``ld``:
    fails when ``lt % 13 == 0``; score ``(lt + ld) % 11`` — or an invalid 99
    when ``ld % 17 == 0``; research when ``ld`` is even; type by
    ``(lt + 2*ld) % 3``."""
    types = ("commissioned", "subsidy", "unknown")

    def scorer(pdf: pd.DataFrame) -> pd.DataFrame:
        raws, errs = [], []
        for t, d in zip(pdf["_title"], pdf["_description"]):
            lt, ld = len(t or ""), len(d or "")
            if lt % 13 == 0:
                raws.append(None); errs.append("scorer call failed")
                continue
            ans = {SCORE_FIELD: 99 if ld % 17 == 0 else (lt + ld) % 11,
                   "reason": f"{lt}/{ld}", "is_research": ld % 2 == 0,
                   "tender_type": types[(lt + 2 * ld) % 3]}
            raws.append(json.dumps(ans, ensure_ascii=False)); errs.append(None)
        return pd.DataFrame({"raw": raws, "error": errs})
    return scorer


# --------------------------------------------------------------------------
# validation

def _field(v: Column, name: str) -> Column:
    return F.call_function("try_variant_get", v, F.lit(f"$.{name}"), F.lit("variant"))


def _vtype(x: Column) -> Column:
    return F.schema_of_variant(x)


def _is_number_type(t: Column) -> Column:
    return t.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE") | t.startswith("DECIMAL")


def _parts(prefix):
    return F.col(prefix + "_t"), F.col(prefix + "_s"), F.col(prefix + "_n")


def validated_score(prefix: str) -> Column:
    """Integral score 0..10 from a field (number, numeric text or bool)."""
    t, s, d = _parts(prefix)
    num = F.when(_is_number_type(t) & (d == F.floor(d)), d)
    txt = F.when((t == "STRING") & s.rlike(r"^[+-]?[0-9]+(\.0*)?$"), s.try_cast("double"))
    boo = F.when(t == "BOOLEAN", F.when(s == "true", F.lit(1.0)).otherwise(F.lit(0.0)))
    val = F.coalesce(num, txt, boo)
    return F.when(val.between(K.SCORE_MIN, K.SCORE_MAX), val.cast("int"))


def validated_reason(prefix: str) -> Column:
    t, s, _ = _parts(prefix)
    return F.when((t == "STRING") & (F.length(s) <= K.SCORER_REASON_MAX_CHARS), s)


def validated_bool(prefix: str) -> Column:
    t, s, d = _parts(prefix)
    low = F.lower(s)
    return (F.when(t == "BOOLEAN", s == "true")
            .when(_is_number_type(t) & d.isin(0.0, 1.0), d == 1.0)
            .when((t == "STRING") & low.isin(*TRUE_WORDS), F.lit(True))
            .when((t == "STRING") & low.isin(*FALSE_WORDS), F.lit(False)))


def validated_type(prefix: str) -> Column:
    t, s, _ = _parts(prefix)
    return F.when((t == "STRING") & s.isin(*K.TENDER_TYPES), s).otherwise(F.lit(K.UNKNOWN))


def validate_answers(df: DataFrame, raw: str = "raw", error: str | None = "scorer_error") -> DataFrame:
    """Add ``ok``, ``error``, ``answer_score``, ``answer_reason``,
    ``answer_is_research``, ``answer_type`` from a raw JSON answer column.

    The answer is parsed once into a VARIANT column and each field taken out
    once; the checks then read those columns."""
    d = df.withColumn("_v", F.try_parse_json(F.col(raw)))
    d = d.withColumn("_obj", F.coalesce(_vtype(F.col("_v")).startswith("OBJECT"), F.lit(False)))
    for name, col in (("_fs", SCORE_FIELD), ("_fr", "reason"), ("_fb", "is_research"), ("_ft", "tender_type")):
        d = d.withColumn(name, _field(F.col("_v"), col))
        d = (d.withColumn(name + "_t", _vtype(F.col(name)))
              .withColumn(name + "_s", F.call_function("try_variant_get", F.col(name), F.lit("$"), F.lit("string")))
              .withColumn(name + "_n", F.call_function("try_variant_get", F.col(name), F.lit("$"), F.lit("double"))))
    d = d.withColumn("_sc", validated_score("_fs")).withColumn("_rs", validated_reason("_fr")) \
         .withColumn("_rb", validated_bool("_fb")).withColumn("_ty", validated_type("_ft"))
    errs = F.concat_ws(",", F.when(F.col("_sc").isNull(), F.lit("score")),
                       F.when(F.col("_rs").isNull(), F.lit("reason")),
                       F.when(F.col("_rb").isNull(), F.lit("is_research")))
    err = (F.when(F.col(error).isNotNull(), F.lit("scorer")) if error else F.lit(None).cast("string"))
    err = F.coalesce(err, F.when(F.col(raw).isNull() | ~F.col("_obj"), F.lit("invalid_json")),
                     F.when(errs != "", errs))
    d = d.withColumn("error", err).withColumn("ok", F.col("error").isNull())
    ok = F.col("ok")
    return d.select(*df.columns, "error", "ok", F.when(ok, F.col("_sc")).alias("answer_score"),
                    F.when(ok, F.col("_rs")).alias("answer_reason"),
                    F.when(ok, F.col("_rb")).alias("answer_is_research"),
                    F.when(ok, F.col("_ty")).alias("answer_type"))


# --------------------------------------------------------------------------
# merge (C4, H23), selections (B7, B8), outcomes

def merge_scores(store: DataFrame, answers: DataFrame, key: str = "id", type_only: bool = False) -> DataFrame:
    """Merge valid answers into the store by id. Score, reason and research
    flag are overwritten; the type only by a confirmed value. Answers for ids
    no longer stored are ignored; rows without an answer are unchanged."""
    # Failed answers ride along and are ignored after the join: a filter on
    # ``ok`` would be pushed down and inline the whole validation into it.
    a = answers.select(
        F.col(key).alias("_aid"), F.col("ok").alias("_ok"), F.col("answer_score").alias("_as"),
        F.col("answer_reason").alias("_ar"), F.col("answer_is_research").alias("_ab"),
        F.col("answer_type").alias("_at"))
    j = store.join(a, store[key] == a["_aid"], "left")
    hit = F.col("_aid").isNotNull() & F.coalesce(F.col("_ok"), F.lit(False))
    cols = []
    for c in store.columns:
        if c == "tender_type":
            cols.append(F.when(hit & (F.col("_at") != K.UNKNOWN), F.col("_at")).otherwise(F.col(c)).alias(c))
        elif not type_only and c == "score":
            cols.append(F.when(hit, F.col("_as").cast("double")).otherwise(F.col(c)).alias(c))
        elif not type_only and c == "ai_reason":
            cols.append(F.when(hit, F.col("_ar")).otherwise(F.col(c)).alias(c))
        elif not type_only and c == "is_research":
            cols.append(F.when(hit, F.col("_ab")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def pending(store: DataFrame, limit: int | None = K.DEFAULT_MAX_RECORDS) -> DataFrame:
    """Rows never scored, lowest ids first, at most ``limit`` (the backlog run size)."""
    p = store.filter(F.col("score").isNull()).orderBy("id")
    return p.limit(limit) if limit is not None else p


def relabel_candidates(store: DataFrame, as_of: _dt.date, limit: int | None = None) -> DataFrame:
    """Rows that may still be shown and carry no confirmed type."""
    c = store.filter((F.col("deadline").isNull() | (F.col("deadline") >= F.lit(as_of)))
                     & (F.col("tender_type").isNull() | (F.col("tender_type") == K.UNKNOWN)))
    if limit is not None:
        c = c.orderBy("id").limit(limit)
    return c


def relabel_outcomes(answers: DataFrame) -> DataFrame:
    """Counts per outcome: the answered type, or 'failed'."""
    out = F.when(F.col("ok"), F.col("answer_type")).otherwise(F.lit("failed"))
    return answers.groupBy(out.alias("outcome")).agg(F.count(F.lit(1)).cast("long").alias("n"))
