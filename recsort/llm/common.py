"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.session import scratch_path

# ASCII letters folded by every operator (other letters stay).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# ASCII white space (space and U+0009 to U+000D).
ASCII_SPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table of a data set folder, reading only ``columns``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage: a lost executor re-reads the files, Python work is not
    repeated, and joins see a plain scan, so that AQE can split hot keys.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **named: Column | str) -> DataFrame:
    """The columns of ``df`` in one struct ``row`` beside the ``named`` ones.

    Whatever extra columns the caller has, they cannot clash with names
    used inside an operator.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    cols = [(F.col(f"`{v}`") if isinstance(v, str) else v).alias(k) for k, v in named.items()]
    return df.select(row, *cols)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; all-ASCII strings take the fast path."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_state(name: str, build):
    """``build()`` once per Python worker, kept between its tasks.

    Functions of this package travel to the workers by value, so a module
    global would be a new one in every task; a module entry is not.
    """
    import sys
    import types
    kept = sys.modules.setdefault("_recsort_worker_state", types.ModuleType("_recsort_worker_state")).__dict__
    if name not in kept:
        kept[name] = build()
    return kept[name]
