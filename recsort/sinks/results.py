"""Sinks: CSV records, JSON event log, and the keyed results tables.

``KeyedResults`` is plain Parquet in folders of a hash bucket of the key. An
upsert reads and rewrites the buckets that its batch touches and no others
(dynamic partition overwrite). ``BatchResults`` is what a stream writes: plain
Parquet in one folder per batch id, overwritten if the batch is replayed, and
read with the latest value of every key.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recsort.constants import RESULT_COLUMNS
from recsort.functions.text import flatten_string_columns
from recsort.operators.state import upsert
from recsort.session import scratch_path

BUCKET = "_bucket"
BATCH = "_batch"


def result_column_names(suffix: str = "") -> list[str]:
    """Plain names, or the second-strategy names with a suffix such as '_v2'."""
    return [c + suffix for c in RESULT_COLUMNS]


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header (a folder of part files; no BOM); cells kept verbatim."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_events(events: DataFrame, path: str) -> None:
    """Append the event log as JSON lines."""
    events.write.mode("append").json(path)


def empty_results(spark: SparkSession, columns: list[str]) -> DataFrame:
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return spark.createDataFrame([], schema)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet folder with the columns of all its files, None if there is none; an unreadable one raises."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class KeyedResults:
    """One row per key, in ``buckets`` folders by a hash of the key.

    ``buckets`` is fixed when the table is made; choose it so that a bucket is
    some hundred MB. A batch with keys in every bucket costs the table, one
    with few keys a few buckets. A failed upsert is repaired by repeating it:
    the new buckets are stored in the scratch folder before the old are replaced.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "vc_id", buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def read(self, columns: list[str] | None = None) -> DataFrame | None:
        """All rows (only those of ``columns`` that the table has), None before the first write."""
        df = _stored(self.spark, self.path)
        if df is None:
            return None
        return df.drop(BUCKET) if columns is None else df.select(*[c for c in columns if c in df.columns])

    def init(self, columns: list[str]) -> DataFrame:
        """The table, made empty with these columns unless it exists."""
        if self.read() is None:
            empty_results(self.spark, columns).write.mode("append").parquet(f"{self.path}/{BUCKET}=0")
        return self.read()

    def upsert(self, batch: DataFrame, seq: str | None = None) -> DataFrame:
        """Update the batch's columns by key and append new keys, in the buckets of the batch's keys."""
        work = scratch_path(self.spark, "upsert")
        # The batch is stored once: its buckets, the merge and a repetition all read the same rows.
        batch.write.parquet(f"{work}/batch")
        new, old = self.spark.read.schema(batch.schema).parquet(f"{work}/batch"), _stored(self.spark, self.path)
        # At most ``buckets`` numbers come to the driver; only those folders are read (partition filter).
        touched = sorted(r[0] for r in new.select(self._bucket()).distinct().collect())
        if not touched:
            return self.init(batch.columns)
        if old is None:
            old = empty_results(self.spark, [self.key])
        else:
            old = old.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = upsert(old, new, self.key, seq).withColumn(BUCKET, self._bucket())
        merged.repartition(len(touched), BUCKET).write.parquet(f"{work}/merged")
        (self.spark.read.parquet(f"{work}/merged").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))
        return self.read()


class BatchResults:
    """Rows of a stream's batches, one folder per batch id; a replayed batch replaces its folder."""

    def __init__(self, spark: SparkSession, path: str, key: str = "vc_id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def batches(self) -> list[int]:
        df = _stored(self.spark, self.path)
        return [] if df is None else sorted(r[0] for r in df.select(BATCH).distinct().collect())

    def latest(self, columns: list[str] | None = None, keys: DataFrame | None = None, before: int | None = None) -> DataFrame | None:
        """The row of the latest batch of every key, None before the first batch.

        ``keys`` (a DataFrame with the key) restricts the rows first, so that a
        lookup aggregates what it asks for; ``before`` leaves out that batch and
        later ones, so that a replayed batch does not see its own first try.
        """
        df = _stored(self.spark, self.path)
        if df is None:
            return None
        names = [c for c in (columns or df.columns) if c in df.columns and c != BATCH]
        df = df.select(*names, BATCH)
        if before is not None:
            df = df.filter(F.col(BATCH) < before)
        if keys is not None:
            df = df.join(keys.select(self.key), self.key, "left_semi")
        others = [c for c in names if c != self.key]
        best = F.max_by(F.struct(*others), F.struct(BATCH, *others))
        return df.groupBy(self.key).agg(best.alias("_r")).select(*[F.col(c) if c == self.key else F.col(f"_r.{c}").alias(c) for c in names])


def sink_rows(df: DataFrame) -> DataFrame:
    """What the writer stores for new rows: line breaks and tabs flattened."""
    return flatten_string_columns(df)
