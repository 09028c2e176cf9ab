"""The three user-level jobs: train the triage model, score records,
classify the routed records into the results table.

Each job reads CSV records (charset picked per file), runs the operators
of this package and writes its output; it returns small statistics
DataFrames (lazy) instead of printing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.operators import classify as C
from recsort.operators import state as S
from recsort.operators import training as TR
from recsort.sinks.results import KeyedResults, result_column_names, sink_rows, write_events, write_records
from recsort.session import scratch_path
from recsort.sources.csv import SCORING_ENCODINGS, TRAINING_ENCODINGS, read_records, require_columns

ROW_ORDER = "_row"


def train_job(spark: SparkSession, input_path: str, model_path: str, text_col: str = "text_combined",
              label_col: str = "isneedai", encodings: Sequence[str] = TRAINING_ENCODINGS,
              **fit_kw) -> dict[str, DataFrame]:
    """Read labelled records (three columns), clean, fit, save the model."""
    records = read_records(spark, input_path, encodings, columns=["vc_id", text_col, label_col])
    clean = TR.train_clean(records, text_col, label_col)
    model = TR.fit_triage(clean, **fit_kw)
    model.write().overwrite().save(model_path)
    return {
        "rejects": TR.label_rejects(records, label_col),
        "distribution": TR.label_distribution(clean),
        "preview": TR.text_preview(clean),
    }


def prediction_stats(scored: DataFrame, flag: str = "need_ai") -> DataFrame:
    """Totals and percentages of the 0/1 flag (null percentages on empty input)."""
    one = S.need_expert(flag)
    agg = scored.agg(F.count(F.lit(1)).alias("n_total"),
                     F.count(F.when(one, 1)).alias("n_need_ai"),
                     F.count(F.when(~one | one.isNull(), 1)).alias("n_no_ai"))
    pct = lambda c: F.round(F.try_divide(F.col(c).cast("double") * 100, F.col("n_total")), 6)
    return agg.select("*", pct("n_need_ai").alias("pct_need_ai"), pct("n_no_ai").alias("pct_no_ai"))


def score_job(spark: SparkSession, input_path: str, output_path: str, model_path: str,
              text_col: str = "text_combined", out_col: str = "need_ai",
              encodings: Sequence[str] = SCORING_ENCODINGS) -> DataFrame:
    """Score every record, write them as CSV, return statistics of the written file.

    The statistics read the written output, so the model is not run twice.
    """
    records = read_records(spark, input_path, encodings)
    require_columns(records, [text_col])  # fails before any model work
    model = PipelineModel.load(model_path)
    write_records(TR.score(model, records, text_col, out_col), output_path)
    written = read_records(spark, output_path, ("utf-8",), null_tokens=None)
    return prediction_stats(written, out_col)


def classify_job(spark: SparkSession, input_path: str, results_root: str, responder,
                 mode: str = "new", suffix: str = "", key: str = "vc_id",
                 encodings: Sequence[str] = ("utf-8", "utf-8-sig"),
                 events_path: str | None = None, run: str | None = None, buckets: int = 16) -> DataFrame:
    """Routed records still to do (``new``) or failed before (``retry``) -> results table.

    Duplicate ids in the input resolve to the last one in file order. The rows
    are upserted into the table's buckets that hold their keys; with
    ``events_path`` the request / response / error events of this run are
    appended there as JSON lines. Returns the per-status summary of this run.

    A responder without a journal of its own gets one beside the results, under
    the name ``run``: a ``new`` run that broke off finds its paid replies when
    the job is started again, a ``retry`` run if it is given the same name.
    """
    records = read_records(spark, input_path, encodings, order_col=ROW_ORDER)
    table = KeyedResults(spark, f"{results_root.rstrip('/')}/table", key, buckets)
    status_col = "process_status" + suffix
    # None before the first run; a table without this version's status column
    # has processed nothing in this version (and has nothing to retry)
    prior = table.read([key, status_col])
    if mode == "retry" and prior is None:
        raise ValueError("retry mode needs an existing results table")
    if not getattr(responder, "row_wise", False) and responder.journal is None:
        responder.journal = f"{results_root.rstrip('/')}/calls"
        responder.run = run or (f"new{suffix}" if mode == "new" else f"retry{suffix}-{uuid.uuid4().hex[:12]}")
    rows = C.classify(records, prior, responder, mode=mode, key=key, suffix=suffix,
                      keep_reply=events_path is not None)
    if events_path is not None:
        results = rows.withColumnsRenamed({c + suffix: c for c in
                                           ("ai_violation_categories", "ai_reason", "process_status")})
        write_events(C.event_log(results, key=key), events_path)
        rows = rows.drop("error", "reply")
    new = sink_rows(S.widen_schema(rows, result_column_names(suffix)))
    # What this run adds is stored before the table changes: its summary is not that of a later state.
    path = scratch_path(spark, "classified")
    S.last_write_wins(new, key, [ROW_ORDER]).drop(ROW_ORDER).write.parquet(path)
    new = spark.read.parquet(path)
    table.upsert(new)
    return C.status_summary(new, status_col=status_col)
