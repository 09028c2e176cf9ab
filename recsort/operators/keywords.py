"""Keyword containment as a join, for a keyword table of any size.

Every keyword has an anchor: the one of its q-grams that the fewest texts hold
(q = 4 code points, or the whole of a shorter keyword). A text that contains
the keyword contains its anchor, so texts and keywords meet in an equi-join on
hashed q-grams, and ``instr`` then decides exactly.

* A text's q-grams meet a bitmap of all keywords' q-grams (128 KB, whatever the
  number of keywords; filled by a partial aggregate) in the stage that cuts
  them, in generated code; the distinct ones left are stored, as 64-bit hashes.
* How many texts hold a q-gram is counted with partial sums. Anchors are rare
  by choice: a q-gram that every text holds is joined only if a keyword has no
  other.
* Candidates travel as (text, keyword), a text named by its key and a hash, and
  meet their text once for all its candidates.

Only built-in functions run; nothing is collected and no keyword list is part
of a plan.

Defined results: null texts, and null and empty keywords, match nothing; rows
that repeat are answered each; a keyword with several categories gives a row
for each, repeated (keyword, category) pairs count once; an empty table on
either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.session import scratch_path

Q = 4
BITS = 1 << 20          # of the bitmap


def _grams(text: Column, q: int) -> Column:
    """The runs of ``q`` code points, overlapping, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1))


def _bit(h: Column) -> Column:
    return F.pmod(h, F.lit(BITS))


def bitmap(hashes: DataFrame) -> DataFrame:
    """One row ``bits``: ``BITS / 64`` longs with the bits of the column ``h`` set."""
    b = _bit(F.col("h"))
    words = hashes.select(F.shiftright(b, 6).cast("int").alias("word"), (b % 64).cast("int").alias("place")) \
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
    every = hashes.sparkSession.range(BITS // 64).select(F.col("id").cast("int").alias("word"))
    return (every.join(words, "word", "left").agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("w"))
            .select(F.col("w.bits").alias("bits")))


def keyword_match(docs: DataFrame, keywords: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keyword, category) for every keyword of the table that the text contains."""
    spark = docs.sparkSession
    work = scratch_path(spark, "keywords")
    words = keywords.filter("length(keyword) > 0").select("keyword").distinct()
    size = F.least(F.lit(Q), F.length("keyword"))
    grams = words.select("keyword", F.explode(F.coalesce(*[F.when(size == q, _grams(F.col("keyword"), q)) for q in range(1, Q + 1)])).alias("g"))
    grams.select("keyword", F.xxhash64("g").alias("h")).distinct().write.parquet(f"{work}/grams")
    grams = spark.read.parquet(f"{work}/grams")
    # Which of the lengths 1 to Q there are, a text need not be cut for others.
    sizes = sorted(r[0] for r in words.select(size).distinct().collect())
    if not sizes:
        return docs.select(key).join(keywords.select("keyword", "category").limit(0))
    bits = bitmap(grams).scalar()
    h = F.col("h")
    seen = F.get(bits, F.shiftright(_bit(h), 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (_bit(h) % 64).cast("int"))) != 0
    cut = docs.filter(F.col(text).isNotNull()).select(key, F.xxhash64(text).alias("th"), F.explode(F.concat(*[_grams(F.col(text), q) for q in sizes])).alias("g"))
    cut.select(key, "th", F.xxhash64("g").alias("h")).filter(seen).distinct().write.parquet(f"{work}/met")
    held = spark.read.parquet(f"{work}/met")
    frequency = held.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    # A keyword with a q-gram that no text holds is in no text.
    anchors = (grams.join(frequency, "h", "left").groupBy("keyword")
               .agg(F.min(F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "h")).alias("a")).filter("a.n > 0").select("keyword", F.col("a.h").alias("h")))
    pairs = held.join(anchors, "h").select(key, "th", "keyword")
    candidates = pairs.groupBy(key, "th").agg(F.collect_set("keyword").alias("keywords"))
    texts = docs.select(F.col(key).alias("_kw_key"), F.col(text).alias("_kw_text"), F.xxhash64(text).alias("_kw_th"))
    found = texts.join(candidates, F.col("_kw_key").eqNullSafe(F.col(key)) & (F.col("_kw_th") == F.col("th"))).select(
        F.col("_kw_key").alias(key), F.explode(F.filter("keywords", lambda k: F.instr(F.col("_kw_text"), k) > 0)).alias("keyword"))
    return found.join(keywords.filter("length(keyword) > 0").select("keyword", "category").distinct(), "keyword").select(key, "keyword", "category")
