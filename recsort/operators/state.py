"""Resume, retry and keyed update of the results table, set-based.

The source workflow keeps an in-memory id set and rewrites its whole
output file after every reply. Here every step is one relational pass:
anti join for "still to do", semi join for "retry", anti join + union for
the keyed update, and a partial-aggregating ``max_by`` for last-write-wins
(no window, so one hot key cannot pin a third of the data to one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.constants import FAILED_STATUSES
from recsort.functions.text import strip_u


def need_expert(c: str | Column = "need_ai") -> Column:
    """Route filter: the flag equals 1 whether stored as number or text."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string").try_cast("double") == F.lit(1.0)


def route_need_ai(records: DataFrame, flag: str = "need_ai") -> DataFrame:
    return records.filter(need_expert(flag))


def processed_ids(prior: DataFrame, status_col: str = "process_status", key: str = "vc_id") -> DataFrame:
    """Ids whose status (stripped, null -> '') is non-empty.

    A prior table without the status column has processed nothing in this
    version (first run of a new strategy over an old file).
    """
    if status_col not in prior.columns:
        return prior.select(F.col(key).cast("string").alias(key)).limit(0)
    st = strip_u(F.coalesce(F.col(status_col), F.lit("")))
    return prior.filter(st != "").select(F.col(key).cast("string").alias(key))


def failed_ids(prior: DataFrame, status_col: str = "process_status", key: str = "vc_id",
               statuses: Sequence[str] = FAILED_STATUSES) -> DataFrame:
    if status_col not in prior.columns:
        return prior.select(F.col(key).cast("string").alias(key)).limit(0)
    return prior.filter(F.col(status_col).isin(list(statuses))) \
        .select(F.col(key).cast("string").alias(key))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.col(key).cast("string"))


def resume_pending(records: DataFrame, prior: DataFrame, status_col: str = "process_status",
                   key: str = "vc_id") -> DataFrame:
    """Routed records that have no finished result yet ('new' mode)."""
    todo = route_need_ai(_keyed(records, key))
    return todo.join(processed_ids(prior, status_col, key), key, "left_anti")


def retry_failed(records: DataFrame, prior: DataFrame, status_col: str = "process_status",
                 key: str = "vc_id") -> DataFrame:
    """Routed records whose prior status is a failure ('retry' mode).

    Failed ids that are not in the input are ignored.
    """
    todo = route_need_ai(_keyed(records, key))
    return todo.join(failed_ids(prior, status_col, key), key, "left_semi")


def last_write_wins(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    ``max_by`` aggregates partially before the shuffle, so a key holding a
    large share of the rows costs one small partial row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in others])


def upsert(prior: DataFrame, batch: DataFrame, key: str = "vc_id", seq: str | None = None) -> DataFrame:
    """Update the batch's columns by key, append new keys; widen the schema.

    A column that only ``prior`` has keeps its values, so a second strategy's
    result columns stand beside the first one's. Every prior row that shares
    a key is updated. Duplicate keys inside ``batch`` keep the last by ``seq`` (processing
    order), without ``seq`` the greatest row by the other columns in their order.
    Idempotent: upserting the same batch twice gives the same table.
    """
    b = _keyed(batch, key)
    others = [c for c in b.columns if c not in (key, seq)]
    b = last_write_wins(b, key, ([seq] if seq is not None else []) + others)
    b = b.drop(seq) if seq is not None else b
    p = _keyed(prior, key).select(F.struct("*").alias("_old"), F.col(key).alias("_p"))
    j = p.join(b.select(F.struct("*").alias("_new"), F.col(key).alias("_b")), F.col("_p").eqNullSafe(F.col("_b")), "full_outer")
    names = list(dict.fromkeys([*prior.columns, *b.columns]))

    def value(c: str) -> Column:
        if c not in b.columns:
            return F.col(f"_old.{c}")
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) if c in prior.columns else F.col(f"_new.{c}")

    return j.select(*[(F.coalesce("_b", "_p") if c == key else value(c)).alias(c) for c in names])


def widen_schema(df: DataFrame, new_columns: Sequence[str]) -> DataFrame:
    """Append the given string columns unless already present, in order."""
    missing = [c for c in new_columns if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
