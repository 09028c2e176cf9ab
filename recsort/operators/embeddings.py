"""Vector head of the triage model: class centroids and cosine scores.

The source workflow trains a sentence-embedding classifier with a cosine
loss. Over given vectors, the SQL-checkable form is a nearest-centroid
classifier: ``Summarizer.mean`` per class (partial aggregation, no
explode), then cosine against the centroids.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsort.functions.vectors import as_double_array, cosine
from recsort.operators.joins import is_bounded

MAX_CLASSES = 100_000


def centroids(vectors: DataFrame, vec: str = "embedding", label: str = "label") -> DataFrame:
    """(label, centroid array<double>) - mean vector per class."""
    v = vectors.select(label, array_to_vector(as_double_array(F.col(vec))).alias("_v"))
    return v.groupBy(label).agg(Summarizer.mean(F.col("_v")).alias("_m")) \
        .select(label, vector_to_array("_m").alias("centroid"))


def cosine_to_centroid(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding",
                       label: str = "label", digits: int = 6) -> DataFrame:
    """Cosine of each vector to its own class centroid."""
    c = centroids(vectors, vec, label)
    if is_bounded(c, MAX_CLASSES):
        c = F.broadcast(c)
    j = vectors.select(key, label, as_double_array(F.col(vec)).alias("_x")).join(c, label)
    return j.select(key, label, F.round(cosine(F.col("_x"), F.col("centroid")), digits).alias("cosine"))


def centroid_classify(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding",
                      label: str = "label", digits: int = 6) -> DataFrame:
    """Predict the class whose centroid is most cosine-similar."""
    c = centroids(vectors, vec, label)
    if not is_bounded(c, MAX_CLASSES):
        raise ValueError("too many classes to ship the centroids to every task")
    rows = c.collect()  # bounded: one row per class
    table = F.array(*[F.struct(F.lit(r[label]).cast(vectors.schema[label].dataType).alias("label"),
                               F.array(*[F.lit(float(x)) for x in r["centroid"]]).alias("centroid"))
                      for r in rows])
    x = as_double_array(F.col(vec))
    scored = F.transform(table, lambda t: F.struct(cosine(x, t["centroid"]).alias("cos"),
                                                   t["label"].alias("label")))
    staged = vectors.select(key, label, F.array_max(scored).alias("_best"))
    return staged.select(key, label, F.col("_best.label").alias("predicted"),
                         F.round(F.col("_best.cos"), digits).alias("cosine"))


def fit_vector_head(vectors: DataFrame, vec: str = "embedding", label: str = "label",
                    max_iter: int = 50, reg: float = 0.01) -> LogisticRegressionModel:
    """Classifier head on given vectors (multinomial logistic regression)."""
    train = vectors.select(array_to_vector(as_double_array(F.col(vec))).alias("features"),
                           F.col(label).cast("double").alias("label_d"))
    lr = LogisticRegression(featuresCol="features", labelCol="label_d", maxIter=max_iter, regParam=reg,
                            family="multinomial")
    return lr.fit(train)


def apply_vector_head(model: LogisticRegressionModel, vectors: DataFrame, key: str = "vec_id",
                      vec: str = "embedding", label: str = "label") -> DataFrame:
    x = vectors.select(key, label, array_to_vector(as_double_array(F.col(vec))).alias("features"))
    return model.transform(x).select(key, label, F.col("prediction").cast("long").alias("predicted"))
