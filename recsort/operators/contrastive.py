"""Contrastive fit of the triage model: a projection learnt from pairs, then a head.

Texts become hashed character n-gram vectors (log counts, unit length). A
projection to a few dimensions is trained so that the cosine of two texts is 1
if they share a label and 0 if not, over the pairs of ``contrastive_pairs``:
every step is one pass over the stored pairs, in which each task adds up the
gradient of its own, partial gradients are summed by a tree of ``FAN``, and the
driver takes one Adam step on a matrix of fixed size (features x dims). A
logistic regression over the projected vectors is the head.

The pairs are stored in blocks of anchors with near ranks, which have the same
partners: a block holds the vector of each of its texts once and its pairs as
places among them, so a step projects a text once a block, not once for each of
its pairs. Blocks are dealt to cells and sums are taken in the order of the
cells, so that equal seeds give equal models. What a step sends is one matrix a
cell; texts are read once.

Null texts count as empty, which is the zero vector: cosine 0 with all, no
gradient.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.operators.training import SAMPLE_SEED, ranked_pairs
from recsort.session import scratch_path

FEATURES = 4096
DIMS = 32
STEPS = 20
RATE = 0.02
CELLS = 16      # partial gradients of a step at least
CELL_ROWS = 1 << 15  # rows of a cell
FAN = 8
ROWS = 256      # texts projected at a time
ANCHORS = 128   # ranks of a block
PAIRS = 1024    # pairs of a block that are dealt by a hash


def hashed(text: str | None, features: int, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) of a text's n-grams: log of 1 + count, unit length."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(code) < ngram:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    h = np.zeros(len(code) - ngram + 1, np.uint64)
    for k in range(ngram):
        h = (h ^ code[k:len(code) - ngram + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    slot, n = np.unique(h % np.uint64(features), return_counts=True)
    w = np.log1p(n)
    return slot.astype(np.int32), (w / np.linalg.norm(w)).astype(np.float32)


def text_vectors(df: DataFrame, text_col: str = "text", features: int = FEATURES, ngram: int = 3, keep: tuple[str, ...] = ("vc_id", "label")) -> DataFrame:
    """The ``keep`` columns and (slots, weights), little-endian int32 and float32."""
    src = df.select(*keep, F.col(text_col).cast("string").alias("text_"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, weights = zip(*[hashed(t, features, ngram) for t in b.column("text_").to_pylist()]) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array([s.tobytes() for s in slots], pa.binary()),
                                              pa.array([w.tobytes() for w in weights], pa.binary())], names=[*keep, "slots", "weights"])

    return src.mapInArrow(run, f"{kept}, slots binary, weights binary")


def dense(slots: list[bytes], weights: list[bytes], features: int) -> np.ndarray:
    out = np.zeros((len(slots), features), np.float32)
    row = np.repeat(np.arange(len(slots)), [len(s) // 4 for s in slots])
    out[row, np.frombuffer(b"".join(slots), "<i4")] = np.frombuffer(b"".join(weights), "<f4")
    return out


def pair_gradients(u: np.ndarray, v: np.ndarray, similar: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum over pairs of projected texts of (cosine - similar)^2 and its gradients by ``u`` and ``v``."""
    nu, nv = np.linalg.norm(u, axis=1), np.linalg.norm(v, axis=1)
    ok = (nu > 0) & (nv > 0)
    nu, nv = np.where(ok, nu, 1.0), np.where(ok, nv, 1.0)
    cos = np.where(ok, (u * v).sum(1) / (nu * nv), 0.0)
    d = np.where(ok, 2 * (cos - similar), 0.0)[:, None]
    du = d * (v / (nu * nv)[:, None] - (cos / nu ** 2)[:, None] * u)
    dv = d * (u / (nu * nv)[:, None] - (cos / nv ** 2)[:, None] * v)
    return float(((cos - similar) ** 2).sum()), du, dv


def loss_and_gradient(w: np.ndarray, a: np.ndarray, b: np.ndarray, similar: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over pairs of (cosine - similar)^2 and its gradient by ``w``."""
    loss, du, dv = pair_gradients(a @ w, b @ w, similar)
    return loss, a.T @ du + b.T @ dv


def block_gradient(w: np.ndarray, x: np.ndarray, left: np.ndarray, right: np.ndarray, similar: np.ndarray) -> tuple[float, np.ndarray]:
    """The same for pairs of rows of ``x``: each row is projected once, and the gradients of its pairs are added before they go back."""
    p = x @ w
    loss, du, dv = pair_gradients(p[left], p[right], similar)
    at = np.zeros_like(p)
    np.add.at(at, left, du)
    np.add.at(at, right, dv)
    return loss, x.T @ at


PARTIAL = "cell int, n long, loss double, gradient binary"
# sizes, slots and weights of a block's vectors end to end; pairs as places among them
BLOCK = "cell int, sizes binary, slots binary, weights binary, lefts binary, rights binary, similar binary"


def _block(features: int, ngram: int):
    narrow = "<u2" if features <= 1 << 16 else "<i4"

    def build(group: pa.Table) -> pa.Table:
        """One row of the (cell, block, id, other, similar, text) rows of a block: texts have no ``similar``."""
        pairs, texts = [], []
        for i, other, similar, text in zip(*(group.column(c).to_pylist() for c in ("id", "other", "similar", "text")), strict=True):
            if similar is None:
                texts.append((i, text or ""))
            else:
                pairs.append((i, other, similar))
        texts.sort()
        places = defaultdict(list)  # rows may share an id: a pair of ids is a pair of all their texts
        for k, (i, _) in enumerate(texts):
            places[i].append(k)
        found = [(a, b, y) for i, j, y in sorted(pairs) for a, b in product(places[i], places[j])]
        slots, weights = zip(*[hashed(t, features, ngram) for _, t in texts]) if texts else ((), ())
        flat = lambda parts, kind: np.concatenate([np.empty(0), *parts]).astype(kind).tobytes()
        lefts, rights, similar = zip(*found) if found else ((), (), ())
        row = {"sizes": np.array([len(s) for s in slots], "<i4").tobytes(), "slots": flat(slots, narrow), "weights": flat(weights, "<f4"),
               "lefts": np.array(lefts, "<i4").tobytes(), "rights": np.array(rights, "<i4").tobytes(), "similar": np.array(similar, "<f4").tobytes()}
        return pa.table({"cell": pa.array([group.column("cell")[0].as_py()], pa.int32())} | {c: pa.array([v], pa.binary()) for c, v in row.items()})

    return build


def _partials(weights, features: int):
    narrow = "<u2" if features <= 1 << 16 else "<i4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value.astype(np.float32)  # products in 32 bits, sums in 64
        found: dict[int, list] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                cell = batch.column("cell")[k].as_py()
                sizes, slots, values, lefts, rights, similar = (np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in (
                    ("sizes", "<i4"), ("slots", narrow), ("weights", "<f4"), ("lefts", "<i4"), ("rights", "<i4"), ("similar", "<f4")))
                x = np.zeros((len(sizes), features), np.float32)
                x[np.repeat(np.arange(len(sizes)), sizes), slots] = values
                loss, g = block_gradient(w, x, lefts, rights, similar)
                t = found.setdefault(cell, [0, 0.0, np.zeros(w.shape)])
                t[0], t[1] = t[0] + len(similar), t[1] + loss
                t[2] += g
        out = sorted(found.items())
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int32()), pa.array([t[0] for _, t in out], pa.int64()),
                                          pa.array([t[1] for _, t in out], pa.float64()), pa.array([t[2].tobytes() for _, t in out], pa.binary())],
                                         names=["cell", "n", "loss", "gradient"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """One row for all rows of a group, added in the order of their cells."""
    rows = sorted(zip(*[table.column(c).to_pylist() for c in ("cell", "n", "loss", "gradient")]))
    total = np.sum([np.frombuffer(r[3]) for r in rows], axis=0)
    return pa.table({"cell": pa.array([rows[0][0]], pa.int32()), "n": pa.array([sum(r[1] for r in rows)], pa.int64()),
                     "loss": pa.array([sum(r[2] for r in rows)], pa.float64()), "gradient": pa.array([total.tobytes()], pa.binary())})


def _summed(partials: DataFrame, cells: int, fan: int = FAN) -> tuple[int, float, np.ndarray]:
    """(pairs, loss, gradient), summed by groups of ``fan`` until as few are left for the driver."""
    width = 1
    while cells > fan:
        width *= fan
        partials = partials.groupBy((F.col("cell") / width).cast("int").alias("group")).applyInArrow(_added, PARTIAL)
        cells = -(-cells // fan)
    last = _added(partials.toArrow())
    return last["n"][0].as_py(), last["loss"][0].as_py(), np.frombuffer(last["gradient"][0].as_py())


class ContrastiveModel:
    """A projection, the n-gram settings it was trained with, and a head; ``losses`` is the mean loss before each step."""

    def __init__(self, w: np.ndarray, ngram: int, head: LogisticRegressionModel | None = None, losses: list[float] | None = None):
        self.w, self.ngram, self.head, self.losses = w, ngram, head, losses or []

    def embed(self, df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("vc_id", "label")) -> DataFrame:
        """The ``keep`` columns and ``embedding``, the projected unit vector (zeros for a text without n-grams)."""
        spark, w = df.sparkSession, self.w
        shared, features, dims = spark.sparkContext.broadcast(w), w.shape[0], w.shape[1]
        vectors = text_vectors(df, text_col, features, self.ngram, keep)
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields[:-2])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for big in batches:
                for lo in range(0, big.num_rows, ROWS):
                    b = big.slice(lo, ROWS)
                    u = dense(b.column("slots").to_pylist(), b.column("weights").to_pylist(), features) @ shared.value
                    u = u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * dims, pa.int32()), pa.array(u.ravel(), pa.float64()))
                    yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], flat], names=[*keep, "embedding"])

        return vectors.mapInArrow(run, f"{kept}, embedding array<double>")

    def score(self, records: DataFrame, text_col: str = "text_combined", key: str = "vc_id", out_col: str = "need_ai") -> DataFrame:
        """(key, ``out_col`` 0/1) per record."""
        x = self.embed(records, text_col, (key,)).withColumn("features", array_to_vector("embedding"))
        return self.head.transform(x).select(key, F.col("prediction").cast("int").alias(out_col))

    def save(self, path: str) -> None:
        """Projection and head under ``path``, replacing what is there."""
        spark = SparkSession.active()
        spark.createDataFrame([(bytearray(np.ascontiguousarray(self.w).tobytes()), *self.w.shape, self.ngram, self.losses)],
                              "w binary, features int, dims int, ngram int, losses array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/projection")
        self.head.write().overwrite().save(f"{path}/head")

    @classmethod
    def load(cls, path: str) -> ContrastiveModel:
        r = SparkSession.active().read.parquet(f"{path}/projection").first()
        w = np.frombuffer(bytes(r.w)).reshape(r.features, r.dims)
        return cls(w, r.ngram, LogisticRegressionModel.load(f"{path}/head"), list(r.losses))


def stored_pairs(clean: DataFrame, pairs: DataFrame, features: int, ngram: int, cells: int, key: str = "vc_id") -> DataFrame:
    """The pairs in blocks with the vectors of their texts, written once in cells.

    Pairs with the ``rank`` of their anchor come into blocks of near ranks, where they
    share most of their texts; other pairs are dealt by a hash of the anchor.
    """
    spark = clean.sparkSession
    path = scratch_path(spark, "contrastive")
    if "rank" in pairs.columns:
        block = F.floor(F.col("rank") / ANCHORS)
    else:
        block = F.pmod(F.xxhash64("anchor_id"), F.lit(max(1, -(-pairs.count() // PAIRS))))
    dealt = pairs.select(block.cast("bigint").alias("block"), F.col("anchor_id").alias("id"), F.col("partner_id").alias("other"), "similar").filter("id IS NOT NULL AND other IS NOT NULL")
    asked = dealt.select("block", F.explode(F.array("id", "other")).alias("id")).distinct()
    texts = clean.select(F.col(key).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(asked, "id")
    rows = dealt.unionByName(texts, allowMissingColumns=True).withColumn("cell", F.pmod("block", F.lit(cells)).cast("int"))
    rows.repartition(cells, "cell").groupBy("cell", "block").applyInArrow(_block(features, ngram), BLOCK).write.parquet(path)
    return spark.read.parquet(path)


def fit_projection(clean: DataFrame, pairs: DataFrame | None = None, features: int = FEATURES, dims: int = DIMS, ngram: int = 3,
                   steps: int = STEPS, rate: float = RATE, seed: int = SAMPLE_SEED, cells: int | None = None, k: int = 2) -> ContrastiveModel:
    """Train the projection on ``clean`` (vc_id, text, label 0/1); without ``cells`` there are as many as the rows ask for."""
    sc = clean.sparkSession.sparkContext
    n_rows = clean.count()
    cells = cells or max(CELLS, -(-n_rows // CELL_ROWS))
    data = stored_pairs(clean, ranked_pairs(clean, n_rows, k=k, seed=seed) if pairs is None else pairs, features, ngram, cells)
    w = np.random.default_rng(seed).normal(size=(features, dims)) / np.sqrt(dims)
    first, second = np.zeros_like(w), np.zeros_like(w)
    losses = []
    for step in range(1, steps + 1):
        shared = sc.broadcast(w)
        n, loss, g = _summed(data.mapInArrow(_partials(shared, features), PARTIAL), cells)
        shared.unpersist()
        losses.append(loss / max(n, 1))
        g = g.reshape(w.shape) / max(n, 1)
        # Adam with its usual constants
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return ContrastiveModel(w, ngram, losses=losses)


def fit_head(features: DataFrame, reg: float = 0.001, max_iter: int = 100) -> LogisticRegressionModel:
    """Logistic regression over (``features``, label)."""
    return LogisticRegression(featuresCol="features", labelCol="label_d", maxIter=max_iter, regParam=reg) \
        .fit(features.select("features", F.col("label").cast("double").alias("label_d")))


def fit_contrastive(clean: DataFrame, **kw) -> ContrastiveModel:
    """Projection and head over ``clean`` (vc_id, text, label 0/1)."""
    model = fit_projection(clean, **kw)
    features = model.embed(clean).select(array_to_vector("embedding").alias("features"), "label").persist()
    try:
        model.head = fit_head(features)
    finally:
        features.unpersist()
    return model
