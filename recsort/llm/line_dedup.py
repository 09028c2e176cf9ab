"""Line dedup over levelled sorted runs of line hashes (native).

Documents are taken in batches of ascending id. A batch reduces its lines to
one row per key hash, merge-joins that with the runs written so far (bucketed
and sorted by hash, so the runs are neither shuffled nor sorted again) and is
written as a run of its own; after ``fanout`` runs of a level they are merged
into one run of the next level. A key known to a run, or held by two documents
of the batch, is dropped everywhere but in the smallest document id.

Defined results:

* null or empty text: one empty line, nothing dropped; null text comes out as "";
* null id: one document that counts as larger than any other id;
* rows with the same id are the same document: their lines are no copies of
  each other, and all of them stay where that id is the smallest;
* an empty table gives an empty table; extra columns pass through untouched.

The key hash has 96 bits (``xxhash64`` and ``hash`` of the key).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.llm.common import ASCII_SPACE, ascii_lower, packed, shuffle_partitions, staged

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """The runs: bucketed tables of (h1, h2, keep), by level."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = shuffle_partitions(spark)
        self.levels: list[list[str]] = [[]]
        self.made: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        df.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet").saveAsTable(name)
        self.made.append(name)
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).filter("is_new").select(*HASH, F.col("first").alias("keep"))

    def add(self, keys: DataFrame) -> DataFrame:
        """``keys``: (h1, h2, first, several) of a batch, one row per hash.

        Writes them as a run and returns (h1, h2, keep) of the keys whose lines go.
        """
        keys = keys.withColumn("known", F.lit(False)).withColumn("old", F.lit(None).cast("bigint"))
        for name in [n for level in self.levels for n in level]:
            run = self._run(name).select(*HASH, "keep", F.lit(True).alias("hit"))
            keys = (keys.join(run, HASH, "left")
                    .withColumn("old", F.when(F.col("hit"), F.col("keep")).otherwise(F.col("old")))
                    .withColumn("known", F.col("known") | F.coalesce(F.col("hit"), F.lit(False)))
                    .drop("keep", "hit"))
        name = self._write(keys.withColumn("is_new", ~F.col("known")))
        self.levels[0].append(name)
        t = self.spark.table(name).filter("known or several")
        return t.select(*HASH, F.when(F.col("known"), F.col("old")).otherwise(F.col("first")).alias("keep"))

    def compact(self) -> None:
        """Merge each full level into one run of the next."""
        for i in range(len(self.levels)):
            if len(self.levels[i]) < self.fanout:
                continue
            runs = [self._run(n) for n in self.levels[i]]
            merged = runs[0]
            for r in runs[1:]:
                merged = merged.unionByName(r)
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(self._write(
                merged.repartition(self.buckets, *HASH).select(*HASH, F.col("keep").alias("first"), F.lit(True).alias("is_new"))))
            self.levels[i] = []

    def drop(self) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, n_batches: int, fanout: int, min_chars: int) -> DataFrame:
    """(id, th, cut): the line numbers to drop of each document text that loses any, ascending."""
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    occ = (src.select("id", F.xxhash64("text").alias("th"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
           .withColumn("key", line_key(F.col("line")))
           .filter(F.length("key") >= min_chars)
           .select("id", "th", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2")))
    cuts = src.agg(F.percentile_approx("id", [i / n_batches for i in range(1, n_batches)]).alias("q")).first()["q"] or []
    edges = [None, *sorted(set(cuts)), None]
    runs, drops = LineRuns(spark, fanout), None
    try:
        for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            inside = F.lit(True)
            if lo is not None:
                inside = inside & (F.col("id") > lo)
            if hi is not None:
                inside = inside & (F.col("id") <= hi)
            else:
                inside = inside | F.col("id").isNull()
            part = occ.filter(inside)
            keys = (part.groupBy(*HASH)
                    .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("nulls"))
                    .select(*HASH, "first", (~F.col("first").eqNullSafe(F.col("last")) | (F.col("nulls") & F.col("first").isNotNull())).alias("several")))
            gone = staged(runs.add(keys), "line-keys")
            out = part.join(gone, HASH).filter(~F.col("id").eqNullSafe(F.col("keep"))).select("id", "th", "pos").distinct()
            drops = out if drops is None else drops.unionByName(out)
            if k + 2 < len(edges):
                runs.compact()
    finally:
        runs.drop()
    return staged(drops.groupBy("id", "th").agg(F.array_sort(F.collect_list("pos")).alias("cut")), "line-drops")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_batches: int = 4,
                fanout: int = 2, min_chars: int = 10) -> DataFrame:
    """``row`` (all input columns), ``kept_text``, ``n_lines`` and ``n_dropped`` of every row."""
    cuts = dropped_lines(docs, id_col, text_col, n_batches, fanout, min_chars)
    rows = packed(docs, id=id_col, text=text_col).withColumn("th", F.xxhash64("text"))
    c = cuts.select(F.col("id").alias("c_id"), F.col("th").alias("c_th"), "cut")
    out = rows.join(c, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th")), "left")
    lines = out.withColumn("lines", lines_of(F.col("text")))
    # One flag a line in one pass: between two dropped numbers only kept lines.
    gaps = F.flatten(F.transform("cut", lambda p, i: F.concat(
        F.array_repeat(F.lit(True), (p - F.when(i == 0, F.lit(-1)).otherwise(F.get(F.col("cut"), i - 1)) - 1).cast("int")),
        F.array(F.lit(False)))))
    flagged = F.filter(F.zip_with("lines", gaps, lambda line, keep: F.when(F.coalesce(keep, F.lit(True)), line)),
                       lambda line: line.isNotNull())
    text = F.when(F.col("cut").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(flagged, "\n"))
    return lines.select("row", text.alias("kept_text"), F.size("lines").cast("long").alias("n_lines"),
                        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("n_dropped"))
