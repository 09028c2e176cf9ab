"""Checks on classification results against the category contract.

The prompt of the source workflow asks the responder to follow these
rules; nothing there checks them. Each check here is a set-based pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.constants import CATCH_ALL_CATEGORY, SELF_MADE_MARKER, STATUS_OK
from recsort.functions.text import split_categories
from recsort.operators.joins import broadcast_if_bounded

# Ours: a catch-all answer is only allowed for near-empty text.
CATCH_ALL_MAX_TEXT = 20
MAX_CATEGORIES = 2


def category_array(c: str | Column = "ai_violation_categories") -> Column:
    return split_categories(F.col(c) if isinstance(c, str) else c)


def explode_categories(results: DataFrame, key: str = "vc_id",
                       col: str = "ai_violation_categories") -> DataFrame:
    """(key, pos, category) for successful results."""
    ok = results.filter(F.col("process_status") == STATUS_OK)
    return ok.select(key, F.posexplode(category_array(col)).alias("pos", "category"))


def off_vocab_categories(exploded: DataFrame, vocab: DataFrame, key: str = "vc_id") -> DataFrame:
    """Categories neither in the vocabulary nor carrying the self-made marker."""
    v = broadcast_if_bounded(vocab.select("category").distinct())
    return exploded.filter(~F.col("category").endswith(SELF_MADE_MARKER)) \
        .join(v, "category", "left_anti").select(key, "pos", "category")


def category_contract(results: DataFrame, text: str = "text_combined", key: str = "vc_id",
                      pairing_category: str = "noncommercial",
                      catch_all: str = CATCH_ALL_CATEGORY) -> DataFrame:
    """Per successful row: which contract rules it breaks.

    * more than two categories;
    * a category repeated;
    * the pairing rule: ``pairing_category`` must come with another category;
    * the catch-all only for (near-)empty text.
    """
    ok = results.filter(F.col("process_status") == STATUS_OK) \
        .select(key, text, category_array().alias("_arr"))
    arr = F.col("_arr")
    n = F.size(arr)
    return ok.select(
        key,
        n.alias("n_categories"),
        (n > MAX_CATEGORIES).alias("too_many"),
        (n != F.size(F.array_distinct(arr))).alias("has_repeats"),
        (F.array_contains(arr, pairing_category) & (F.size(F.array_distinct(arr)) < 2)).alias("pairing_broken"),
        (F.array_contains(arr, catch_all) &
         (F.coalesce(F.length(F.col(text)), F.lit(0)) > CATCH_ALL_MAX_TEXT)).alias("catch_all_misused"),
    ).withColumn("contract_ok", ~(F.col("too_many") | F.col("has_repeats") | F.col("pairing_broken")
                                  | F.col("catch_all_misused")))


QUOTE_SPAN = "[“\"「『]([^”\"」』]+)[”\"」』]"


def evidence_check(results: DataFrame, text: str = "text_combined", key: str = "vc_id",
                   reason: str = "ai_reason") -> DataFrame:
    """The reason must quote the source: every quoted span must occur in the text."""
    ok = results.filter(F.col("process_status") == STATUS_OK).select(
        key, F.coalesce(F.col(text), F.lit("")).alias("_t"),
        F.regexp_extract_all(F.col(reason), F.lit(QUOTE_SPAN), F.lit(1)).alias("_spans"))
    found = F.size(F.filter("_spans", lambda s: F.instr(F.col("_t"), s) > 0))
    return ok.select(key, F.size("_spans").alias("n_spans"), found.alias("n_found")) \
        .withColumn("evidence_ok", (F.col("n_spans") > 0) & (F.col("n_found") == F.col("n_spans")))


def category_frequency(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("category").agg(F.count(F.lit(1)).alias("n"),
                                            F.countDistinct("vc_id").alias("n_records"))
