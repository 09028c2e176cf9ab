"""Training-data pipeline over the ``documents`` table.

Five stages, each one of the operators of ``recsort.llm``, each working on all
its predecessor kept. ``run`` writes every stage's result as Parquet to the
shared scratch folder and rereads it, so that a lost executor never costs more
than its own stage. All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.llm.common import read, staged
from recsort.llm.decontaminate import decontaminate
from recsort.llm.line_dedup import dedup_lines
from recsort.llm.packing import pack
from recsort.llm.quality_rules import judge
from recsort.llm.simhash import near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or the outlier test reject go.

    Null and empty texts have too few words and go; a null language or source
    is a group of its own; rows that repeat have one verdict.
    """
    return judge(docs).filter("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines held by a smaller document go; ``n_chars`` follows the text.

    Every row stays, a null text as an empty one. A null id is larger than any
    other; rows with one id are one document and keep each other's lines.
    """
    out = dedup_lines(docs)
    return out.select(*[F.col("kept_text").alias("text") if c == "text" else F.length("kept_text").cast("long").alias("n_chars") if c == "n_chars"
                        else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    Null and empty texts have one fingerprint and are a group; of rows that
    share the smallest id one stays; a null id stays only where no other is.
    """
    return near_duplicates(docs).filter("stays").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; null and empty texts hold none and stay."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text")).filter("size(items) = 0").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences mixed by source.

    A null or empty text is its end token alone; a null source is a queue of
    its own; rows that repeat are packed once each.
    """
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Concentration steps, bit distances, components and tokenizers have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
