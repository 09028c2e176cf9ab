"""Triage-model side: clean the labelled records, fit and apply a 0/1
classifier, and the checks around it.

The source workflow fine-tunes a sentence-transformer few-shot model on
one GPU. That is re-aimed here as a ``pyspark.ml`` pipeline (character
n-grams -> hashed TF -> IDF -> logistic regression), which fits and
scores on executors; contrastive pairs are built with equi-joins.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsort.constants import TAG_NEEDS_EXPERT, TAG_RULES_ONLY
from recsort.functions.text import seeded_order

SAMPLE_SEED = 42


def _label_number(c):
    return c.try_cast("double")


def train_clean(records: DataFrame, text_col: str = "text_combined", label_col: str = "isneedai") -> DataFrame:
    """Rename to (text, label), drop null labels, int label (truncating), drop null text.

    Labels that are not numbers are left out here and reported by
    ``label_rejects`` instead of ending the job.
    """
    df = records.withColumnsRenamed({text_col: "text", label_col: "label"})
    num = _label_number(F.col("label"))
    return (df.filter(F.col("label").isNotNull() & num.isNotNull())
              .withColumn("label", num.cast("int"))
              .filter(F.col("text").isNotNull())
              .withColumn("text", F.col("text").cast("string")))


def label_rejects(records: DataFrame, label_col: str = "isneedai") -> DataFrame:
    """Rows whose label is present but not a number."""
    return records.filter(F.col(label_col).isNotNull() & _label_number(F.col(label_col)).isNull()) \
        .select("vc_id", F.col(label_col).alias("label"))


def label_distribution(clean: DataFrame) -> DataFrame:
    return clean.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label")


def label_tag(c):
    return F.when(c == 1, F.lit(TAG_NEEDS_EXPERT)).otherwise(F.lit(TAG_RULES_ONLY))


def text_preview(clean: DataFrame, n_rows: int = 5, n_chars: int = 50) -> DataFrame:
    """First rows by id with label tag and a one-line text preview (a top-k report)."""
    from recsort.functions.text import preview
    return clean.orderBy("vc_id").limit(n_rows).select(
        "vc_id", "label", label_tag(F.col("label")).alias("label_tag"),
        preview(F.col("text"), n_chars).alias("preview"))


def seeded_sample(df: DataFrame, n: int = 5, seed: int = SAMPLE_SEED, key: str = "vc_id") -> DataFrame:
    """The same n rows every run, in any engine: smallest seeded MD5 of the key."""
    return df.orderBy(seeded_order(key, seed), key).limit(n)


# ---------------------------------------------------------------------------
# Model

# Overlapping character n-grams in one regex pass (lookahead capture):
# works for any script without a word splitter, and avoids building
# per-character token arrays. Character bigrams have a few thousand
# distinct values per script, so 2^16 hash buckets keep collisions rare
# while every LR iteration aggregates a 4x smaller gradient than 2^18.
def _ngram_sql(n: int) -> str:
    return ("SELECT *, regexp_extract_all(lower(coalesce(text, '')), "
            f"'(?s)(?=(.{{{n}}}))', 1) AS grams FROM __THIS__")


def triage_pipeline(num_features: int = 1 << 16, ngram: int = 2, reg: float = 0.01,
                    max_iter: int = 50) -> Pipeline:
    grams = SQLTransformer(statement=_ngram_sql(ngram))
    tf = HashingTF(inputCol="grams", outputCol="tf", numFeatures=num_features)
    idf = IDF(inputCol="tf", outputCol="features", minDocFreq=2)
    lr = LogisticRegression(featuresCol="features", labelCol="label_d", maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[grams, tf, idf, lr])


def fit_triage(clean: DataFrame, **kw) -> PipelineModel:
    """Fit n-grams -> hashed TF -> IDF -> logistic regression.

    The hashed features are cached once and shared by the IDF pass and
    every LR iteration (a plain ``Pipeline.fit`` would featurise twice).
    """
    grams, tf, idf, lr = triage_pipeline(**kw).getStages()
    train = clean.select("text", F.col("label").cast("double").alias("label_d"))
    feats = tf.transform(grams.transform(train)).select("tf", "label_d").cache()
    try:
        idf_model = idf.fit(feats)
        weighted = idf_model.transform(feats).select("features", "label_d").cache()
        try:
            lr_model = lr.fit(weighted)
        finally:
            weighted.unpersist()
    finally:
        feats.unpersist()
    return PipelineModel(stages=[grams, tf, idf_model, lr_model])


def score(model: PipelineModel, records: DataFrame, text_col: str = "text_combined",
          out_col: str = "need_ai") -> DataFrame:
    """Attach the 0/1 prediction; null text is scored as ''."""
    from recsort.sources.csv import require_columns
    require_columns(records, [text_col])
    keep = records.columns
    x = records.withColumn("text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = model.transform(x)
    return out.select(*[F.col(c) for c in keep if c != out_col],
                      F.col("prediction").cast("int").alias(out_col))


def holdout_split(clean: DataFrame, test_fraction: float = 0.2, seed: int = SAMPLE_SEED):
    """Deterministic hash split on the id (no leakage between fit and check)."""
    b = seeded_order("vc_id", seed) % 1000
    cut = int(round(test_fraction * 1000))
    return clean.filter(b >= cut), clean.filter(b < cut)


def confusion_matrix(model: PipelineModel, test: DataFrame) -> DataFrame:
    scored = score(model, test.withColumnRenamed("text", "text_combined"), out_col="prediction_i")
    return scored.groupBy("label", F.col("prediction_i").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Contrastive pairs

def contrastive_pairs(clean: DataFrame, k: int = 2, rows_per_bucket: int = 4096,
                      seed: int = SAMPLE_SEED) -> DataFrame:
    """k same-label and k other-label partners per row, deterministic.

    The rows of a label are ranked by a seeded hash of the id. Partner j of the
    row with rank r is the one with rank (r + j) mod size of the same label
    (positive), or (r + j - 1) mod size of the other label (negative), so a
    row gets min(k, size - 1) and min(k, size) partners, whatever the sizes
    of the labels. Ranks are numbered in hash ranges of about
    ``rows_per_bucket`` rows and shifted by the rows before the range; how
    many ranges there are does not change them. Only equi-joins on
    (label, rank, salt): no cross join, no all-pairs, and the partners of a
    rare label are repeated by salt, so that none meets all anchors in a task.
    """
    return ranked_pairs(clean, clean.count(), k, rows_per_bucket, seed).drop("rank")


def ranked_pairs(clean: DataFrame, n: int, k: int = 2, rows_per_bucket: int = 4096, seed: int = SAMPLE_SEED) -> DataFrame:
    """The same pairs with the anchor's ``rank``, of ``n`` rows: anchors of near ranks have the same partners."""
    n_buckets = max(1, math.ceil(n / rows_per_bucket))
    h = seeded_order("vc_id", seed)
    bucket = F.shiftright(F.shiftright(h, 28) * F.lit(n_buckets).cast("bigint"), 32)
    base = clean.select("vc_id", "label", bucket.alias("bucket"), h.alias("h"))
    cell = Window.partitionBy("label", "bucket")
    ranked = base.withColumn("rank", F.row_number().over(cell.orderBy("h", "vc_id")) - 1).drop("h")
    # one row per (label, bucket): grows with n / rows_per_bucket
    sizes = base.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("cell_size"))
    before = sizes.select("label", "bucket", (F.sum("cell_size").over(
        Window.partitionBy("label").orderBy("bucket")) - F.col("cell_size")).alias("before"))
    ranked = ranked.join(before, ["label", "bucket"]).select(
        "vc_id", "label", (F.col("rank") + F.col("before")).alias("rank"))
    # one row per label
    totals = sizes.groupBy("label").agg(F.sum("cell_size").alias("size"))

    anchors = ranked.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(k))))
    pos = anchors.withColumn("p_label", F.col("label"))
    # labels are 0/1
    neg = anchors.withColumn("p_label", 1 - F.col("label"))
    of_label = totals.select(F.col("label").alias("p_label"), F.col("size").alias("p_size"),
                             F.greatest(F.lit(1), F.ceil(F.lit(n * k) / F.col("size") / rows_per_bucket)).cast("bigint").alias("salts"))
    same = F.col("label") == F.col("p_label")
    cand = pos.unionByName(neg).join(F.broadcast(of_label), "p_label") \
        .filter(F.when(same, F.col("j") < F.col("p_size")).otherwise(F.col("j") <= F.col("p_size"))) \
        .select(F.col("vc_id").alias("anchor_id"), "label", "p_label", "j", "rank",
                F.pmod(F.col("rank") + F.col("j") - F.when(same, 0).otherwise(1), F.col("p_size")).alias("p_rank"),
                F.pmod(F.xxhash64("vc_id", "j"), F.col("salts")).alias("salt"))
    partners = ranked.withColumnsRenamed({"vc_id": "partner_id", "label": "p_label", "rank": "p_rank"}) \
        .join(F.broadcast(of_label), "p_label") \
        .select("partner_id", "p_label", "p_rank", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"))
    return cand.join(partners, ["p_label", "p_rank", "salt"]).select(
        "anchor_id", "partner_id", F.col("label").alias("anchor_label"),
        F.col("p_label").alias("partner_label"), "j",
        (F.col("label") == F.col("p_label")).cast("double").alias("similar"), "rank")
