"""Training-side operators: clean, rejects, fit/score, pairs, confusion."""

from __future__ import annotations

from pyspark.ml import PipelineModel

from recsort.operators import training as TR
from recsort.sources import fixtures as FX
from tests.conftest import SF_SMALL


def test_clean_and_rejects_partition_labelled_rows(spark):
    f1 = FX.f1_training(spark, SF_SMALL)
    clean, rej = TR.train_clean(f1), TR.label_rejects(f1)
    labelled_text = f1.filter("isneedai is not null and text_combined is not null").count()
    assert clean.count() + rej.filter(rej.vc_id.isin([r.vc_id for r in f1.filter("text_combined is not null").collect()])).count() == labelled_text
    assert set(r.label for r in clean.select("label").distinct().collect()) <= {0, 1}
    assert clean.schema["label"].dataType.simpleString() == "int"


def test_label_truncates_like_int_cast(spark):
    df = spark.createDataFrame([("a", "t", "0.7"), ("b", "t", "1.0"), ("c", "t", "x"), ("d", None, "1"), ("e", "t", None)],
                               "vc_id string, text_combined string, isneedai string")
    got = {r.vc_id: r.label for r in TR.train_clean(df).collect()}
    assert got == {"a": 0, "b": 1}
    assert [r.vc_id for r in TR.label_rejects(df).collect()] == ["c"]


def test_fit_score_save_load(spark, tmp_dir):
    clean = TR.train_clean(FX.f1_training(spark, SF_SMALL))
    model = TR.fit_triage(clean, max_iter=10)
    path = f"{tmp_dir}/model"
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    rec = FX.f2_records(spark, SF_SMALL).select("vc_id", "text_combined")
    a = {r.vc_id: r.need_ai for r in TR.score(model, rec).collect()}
    b = {r.vc_id: r.need_ai for r in TR.score(loaded, rec).collect()}
    assert a == b and set(a.values()) <= {0, 1} and len(a) == rec.count()


def test_score_requires_text_column(spark):
    import pytest
    clean = TR.train_clean(FX.f1_training(spark, SF_SMALL))
    model = TR.fit_triage(clean, max_iter=2)
    with pytest.raises(ValueError, match="available columns"):
        TR.score(model, spark.createDataFrame([("a",)], "vc_id string"))


def test_contrastive_pairs_k_partners_no_self(spark):
    clean = TR.train_clean(FX.f1_training(spark, SF_SMALL))
    pairs = TR.contrastive_pairs(clean, k=2, rows_per_bucket=16).cache()
    assert pairs.filter("anchor_id = partner_id").count() == 0
    assert pairs.filter("(similar = 1.0) != (anchor_label = partner_label)").count() == 0
    per = {(r.anchor_id, r.similar): r.n for r in pairs.groupBy("anchor_id", "similar").count().withColumnRenamed("count", "n").collect()}
    assert max(per.values()) <= 2
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # deterministic
    again = TR.contrastive_pairs(clean, k=2, rows_per_bucket=16)
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, again.collect()))


def test_contrastive_pairs_of_a_rare_label(spark):
    rows = [(i, int(i % 100 == 0), "x") for i in range(300)]
    clean = spark.createDataFrame(rows, "vc_id bigint, label int, text string").repartition(3)
    got = [sorted(map(tuple, TR.contrastive_pairs(clean, k=4, rows_per_bucket=b).collect())) for b in (8, 100_000)]
    assert got[0] == got[1]
    partners = {}
    for r in got[0]:
        assert r[0] != r[1] and r[2] == int(r[0] % 100 == 0) and r[3] == int(r[1] % 100 == 0)
        partners.setdefault((r[0], r[3]), []).append(r[1])
    for i, label, _ in rows:
        for other, size in ((0, 297), (1, 3)):
            p = partners[i, other]
            assert len(p) == len(set(p)) == min(4, size - (label == other))


def test_seeded_sample_is_stable(spark):
    clean = TR.train_clean(FX.f1_training(spark, SF_SMALL))
    a = [r.vc_id for r in TR.seeded_sample(clean).collect()]
    b = [r.vc_id for r in TR.seeded_sample(clean).collect()]
    assert a == b and len(a) == min(5, clean.count())


def test_confusion_matrix_counts_holdout(spark):
    clean = TR.train_clean(FX.f1_training(spark, SF_SMALL))
    fit, test = TR.holdout_split(clean)
    assert fit.join(test, "vc_id").count() == 0
    cm = TR.confusion_matrix(TR.fit_triage(fit, max_iter=5), test)
    assert sum(r.n for r in cm.collect()) == test.count()


def test_vector_head_beats_chance(spark):
    from recsort.operators import embeddings as EM
    from recsort.sources.tables import table
    v = table(spark, SF_SMALL, "embeddings", "vec_id", "embedding", "label")
    pred = EM.apply_vector_head(EM.fit_vector_head(v), v)
    n = pred.count()
    hits = pred.filter("predicted = label").count()
    assert n == v.count() and hits / n > 0.2
