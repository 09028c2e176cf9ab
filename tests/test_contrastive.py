"""Contrastive projection: gradient, descent, equal seeds, head, save and load."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from recsort.operators import contrastive as K
from recsort.operators import training as TR
from recsort.sources import fixtures as FX
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def split(spark):
    clean = TR.train_clean(FX.f1_training(spark, SF_CHECK)).select("vc_id", "text", "label")
    return TR.holdout_split(clean)


@pytest.fixture(scope="module")
def model(split):
    return K.fit_contrastive(split[0])


def test_gradient_is_the_derivative_of_the_loss():
    r = np.random.default_rng(1)
    w, a, b = r.normal(size=(6, 3)), r.random((5, 6)), r.random((5, 6))
    b[4] = 0  # a text without n-grams has no direction
    y = np.array([1, 0, 1, 0, 1.0])
    loss, g = K.loss_and_gradient(w, a, b, y)
    cos = [(x @ w) @ (z @ w) / (np.linalg.norm(x @ w) * np.linalg.norm(z @ w)) for x, z in zip(a[:4], b[:4])] + [0.0]
    assert abs(loss - sum((c - t) ** 2 for c, t in zip(cos, y))) < 1e-9
    for i in range(6):
        for j in range(3):
            d = np.zeros_like(w)
            d[i, j] = 1e-6
            slope = (K.loss_and_gradient(w + d, a, b, y)[0] - K.loss_and_gradient(w - d, a, b, y)[0]) / 2e-6
            assert abs(slope - g[i, j]) < 1e-5


def test_a_step_over_cells_equals_numpy(spark, split, monkeypatch):
    """One pass over the stored pairs, summed by a tree, against the sum over all pairs in one place."""
    monkeypatch.setattr(K, "FAN", 2)
    fit = split[0].limit(60).persist()
    pairs = TR.contrastive_pairs(fit, k=2).persist()
    data = K.stored_pairs(fit, pairs, 512, 3, cells=7)
    w = np.random.default_rng(0).normal(size=(512, 4))
    n, loss, g = K._summed(data.mapInArrow(K._partials(spark.sparkContext.broadcast(w), 512), K.PARTIAL), 7, fan=2)
    text = {r.vc_id: K.hashed(r.text, 512, 3) for r in fit.collect()}
    rows = pairs.collect()
    side = lambda c: K.dense(*zip(*[(s.tobytes(), v.tobytes()) for s, v in (text[r[c]] for r in rows)]), 512)
    want, grad = K.loss_and_gradient(w, side("anchor_id"), side("partner_id"), np.array([r.similar for r in rows]))
    assert n == len(rows) and abs(loss - want) < 1e-3 * want
    assert np.allclose(g.reshape(w.shape), grad, rtol=1e-3, atol=1e-4)


def test_blocks_hold_each_text_once_and_all_pairs(spark):
    """Ranked pairs: few vectors beside the texts themselves, and the sums over all pairs, with labels of any size, repeated ids, null ids and texts."""
    rows = [(f"v{i}", f"text {i % 37} of {i * i}", int(i % 9 == 0)) for i in range(900)]
    rows += [("v3", "another text", 0), (None, "no id", 1), ("short", "x", 0)]
    clean = spark.createDataFrame(rows, "vc_id string, text string, label int").persist()
    pairs = TR.ranked_pairs(clean, clean.count()).persist()
    data = K.stored_pairs(clean, pairs, 256, 3, cells=5).persist()
    assert sum(len(r.sizes) // 4 for r in data.collect()) < 2.2 * len(rows)
    w = np.random.default_rng(0).normal(size=(256, 4))
    n, loss, g = K._summed(data.mapInArrow(K._partials(spark.sparkContext.broadcast(w), 256), K.PARTIAL), 5)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(K.hashed(t, 256, 3))
    want = [(a, b, r.similar) for r in pairs.collect() if None not in (r.anchor_id, r.partner_id) for a in texts[r.anchor_id] for b in texts[r.partner_id]]
    side = lambda c: K.dense(*zip(*[(p[c][0].tobytes(), p[c][1].tobytes()) for p in want]), 256)
    total, grad = K.loss_and_gradient(w, side(0), side(1), np.array([p[2] for p in want]))
    assert n == len(want) > 3500 and abs(loss - total) < 1e-3 * total
    assert np.allclose(g.reshape(w.shape), grad, rtol=1e-3, atol=1e-3)
    assert set(TR.contrastive_pairs(clean).columns) == set(pairs.columns) - {"rank"}


def test_loss_falls_and_the_head_learns(split, model):
    fives = np.array(model.losses).reshape(-1, 5).mean(1)
    assert (np.diff(fives) < 0).all() and fives[-1] < 0.3 * fives[0]
    x = model.embed(split[1]).withColumn("features", array_to_vector("embedding"))
    right = model.head.transform(x).select(F.avg((F.col("prediction") == F.col("label")).cast("double")), F.avg("label")).first()
    assert right[0] > max(right[1], 1 - right[1]) + 0.02  # beyond always naming the commoner label


def test_equal_seeds_give_equal_models(split, model):
    again = K.fit_projection(split[0])
    assert np.array_equal(again.w, model.w) and again.losses == model.losses
    assert not np.array_equal(K.fit_projection(split[0], seed=7, steps=1).w, K.fit_projection(split[0], steps=1).w)


def test_save_load_and_null_text(spark, model, tmp_dir):
    rec = spark.createDataFrame([("a", "some text here"), ("b", None), ("c", "")], "vc_id string, text_combined string")
    model.save(tmp_dir)
    back = K.ContrastiveModel.load(tmp_dir)
    rows = lambda m: sorted(tuple(r) for r in m.score(rec).collect())
    assert rows(back) == rows(model) and len(rows(model)) == 3
    assert [sum(r.embedding) for r in model.embed(rec, "text_combined", ("vc_id",)).filter("vc_id <> 'a'").collect()] == [0, 0]
