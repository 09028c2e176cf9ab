"""Resume / retry / upsert / last-write-wins."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsort.operators import state as S
import os

from recsort.sinks.results import BUCKET, BatchResults, KeyedResults, result_column_names
from recsort.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_pending_and_done_partition_the_routed_input(spark):
    rec, prior = FX.f2_records(spark, SF_SMALL), FX.f6_prior(spark, SF_SMALL)
    routed = S.route_need_ai(rec).select("vc_id")
    pending = S.resume_pending(rec, prior).select("vc_id")
    done = routed.join(S.processed_ids(prior), "vc_id", "left_semi")
    assert pending.join(done, "vc_id").count() == 0
    assert _rows(pending.unionByName(done), "vc_id") == _rows(routed, "vc_id")


def test_blank_status_is_not_processed(spark):
    prior = spark.createDataFrame([("a", "  "), ("b", None), ("c", "成功"), ("d", "　")], "vc_id string, process_status string")
    assert _rows(S.processed_ids(prior), "vc_id") == [("c",)]


def test_missing_status_column_means_nothing_processed(spark):
    rec = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "vc_id string, need_ai int")
    prior = spark.createDataFrame([("a", "old")], "vc_id string, ai_violation_categories string")
    assert _rows(S.resume_pending(rec, prior, "process_status_v2"), "vc_id") == [("a",), ("b",)]
    assert S.retry_failed(rec, prior, "process_status_v2").count() == 0


def test_route_accepts_numbers_and_text(spark):
    rec = spark.createDataFrame([("a", "1"), ("b", "1.0"), ("c", "0"), ("d", "x"), ("e", None)],
                                "vc_id string, need_ai string")
    assert _rows(S.route_need_ai(rec), "vc_id") == [("a",), ("b",)]


def test_retry_ignores_failed_ids_not_in_input(spark):
    rec = spark.createDataFrame([("a", 1), ("b", 1)], "vc_id string, need_ai int")
    prior = spark.createDataFrame([("a", "请求失败"), ("z", "解析失败"), ("b", "成功")], "vc_id string, process_status string")
    assert _rows(S.retry_failed(rec, prior), "vc_id") == [("a",)]


def test_upsert_updates_the_batch_columns_widens_and_is_idempotent(spark):
    prior = spark.createDataFrame([("a", "x", "成功"), ("b", "y", "请求失败")], "vc_id string, note string, process_status string")
    batch = spark.createDataFrame([("b", "成功", "r1"), ("c", "解析失败", "r2")], "vc_id string, process_status string, ai_reason string")
    once = S.upsert(prior, batch)
    twice = S.upsert(once, batch)
    expect = [("a", "x", "成功", None), ("b", "y", "成功", "r1"), ("c", None, "解析失败", "r2")]
    assert _rows(once, "vc_id", "note", "process_status", "ai_reason") == expect
    assert _rows(twice, "vc_id", "note", "process_status", "ai_reason") == expect


def test_second_strategy_keeps_the_first(spark, tmp_dir):
    first = spark.createDataFrame([("a", "x", "成功"), ("b", "y", "成功")], "vc_id string, ai_violation_categories string, process_status string")
    second = spark.createDataFrame([("b", "z", "成功"), ("c", "w", "成功")], "vc_id string, ai_violation_categories_v2 string, process_status_v2 string")
    expect = [("a", "x", "成功", None, None), ("b", "y", "成功", "z", "成功"), ("c", None, None, "w", "成功")]
    cols = ["vc_id", "ai_violation_categories", "process_status", "ai_violation_categories_v2", "process_status_v2"]
    key = lambda rows: sorted(rows, key=repr)
    assert key(tuple(r) for r in S.upsert(first, second).select(*cols).collect()) == key(expect)
    t = KeyedResults(spark, f"{tmp_dir}/second", buckets=4)
    t.upsert(first)
    t.upsert(second)
    assert key(tuple(r) for r in t.read().select(*cols).collect()) == key(expect)


def test_upsert_duplicate_batch_keys_last_wins(spark):
    prior = spark.createDataFrame([("a", "old")], "vc_id string, v string")
    batch = spark.createDataFrame([("a", "first", 1), ("a", "second", 2), ("b", "only", 1)], "vc_id string, v string, seq int")
    assert _rows(S.upsert(prior, batch, seq="seq"), "vc_id", "v") == [("a", "second"), ("b", "only")]


def test_last_write_wins_on_hot_key(spark):
    # one key holds most rows: max_by aggregates partially, result is the latest
    rows = [(1, i, f"e{i}") for i in range(5000)] + [(2, 3, "x"), (2, 3, "y")]
    df = spark.createDataFrame(rows, "user_id int, ts int, payload string").repartition(8)
    out = S.last_write_wins(df.withColumn("event_id", F.col("ts")), "user_id", ["ts", "payload"])
    got = {r.user_id: r.payload for r in out.collect()}
    assert got == {1: "e4999", 2: "y"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "PartialMerge" in plan or "Partial" in plan


def test_widen_schema_keeps_order_and_existing(spark):
    df = spark.createDataFrame([("a", "s")], "vc_id string, process_status string")
    out = S.widen_schema(df, result_column_names())
    assert out.columns == ["vc_id", "process_status", "ai_violation_categories", "ai_reason", "ai_raw_response"]
    assert S.widen_schema(df, result_column_names("_v2")).columns[-1] == "process_status_v2"


def _files(root):
    return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in os.listdir(root) if d.startswith(BUCKET)}


def test_upsert_rewrites_only_the_buckets_of_its_keys(spark, tmp_dir):
    t = KeyedResults(spark, f"{tmp_dir}/res", buckets=16)
    assert t.read() is None
    schema = "vc_id string, process_status string, note string"
    t.upsert(spark.createDataFrame([(f"k{i}", "成功", "v0") for i in range(200)], schema))
    before = _files(t.path)
    assert len(before) == 16
    batch = spark.createDataFrame([("k7", "解析失败", "v1"), ("new", "成功", "v1")], schema)
    t.upsert(batch)
    after = _files(t.path)
    touched = {f"{BUCKET}={r[0]}" for r in batch.select(t._bucket()).collect()}
    assert {d for d in after if after[d] != before[d]} == touched and len(touched) <= 2
    got = {r.vc_id: (r.process_status, r.note) for r in t.read().collect()}
    assert len(got) == 201 and got["k7"] == ("解析失败", "v1") and got["new"] == ("成功", "v1") and got["k8"] == ("成功", "v0")
    t.upsert(batch)  # a repeated batch changes nothing
    assert {r.vc_id: (r.process_status, r.note) for r in t.read().collect()} == got
    assert _rows(t.read(["vc_id", "absent"]).filter("vc_id = 'new'"), "vc_id") == [("new",)]


def test_upsert_of_nothing_and_of_repeated_keys(spark, tmp_dir):
    t = KeyedResults(spark, f"{tmp_dir}/res", buckets=3)
    assert t.init(["vc_id", "process_status"]).count() == 0
    schema = "vc_id string, process_status string, seq int"
    assert t.upsert(spark.createDataFrame([], schema), "seq").count() == 0
    t.upsert(spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "z", 2), (None, "n", 1)], schema), "seq")
    assert sorted(t.read().select("vc_id", "process_status").collect(), key=repr) == sorted([("a", "y"), (None, "n")], key=repr)


def test_upsert_without_order_keeps_one_row_per_key(spark):
    prior = spark.createDataFrame([("a", "old")], "vc_id string, v string")
    batch = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", None), ("b", "w")], "vc_id string, v string")
    assert _rows(S.upsert(prior, batch), "vc_id", "v") == [("a", "y"), ("b", "w")]


def test_batch_results_latest(spark, tmp_dir):
    t = BatchResults(spark, f"{tmp_dir}/stream")
    assert t.latest() is None and t.batches() == []
    schema = "vc_id string, process_status string, note string"
    t.write(spark.createDataFrame([("a", "请求失败", "v0"), ("b", "成功", "v0")], schema), 0)
    t.write(spark.createDataFrame([("a", "成功", None), ("c", "解析失败", "v1")], schema), 1)
    expect = [("a", "成功", None), ("b", "成功", "v0"), ("c", "解析失败", "v1")]
    assert _rows(t.latest(), "vc_id", "process_status", "note") == expect
    assert _rows(t.latest(["vc_id", "process_status"], before=1), "vc_id", "process_status") == [("a", "请求失败"), ("b", "成功")]
    keys = spark.createDataFrame([("a",), ("z",)], "vc_id string")
    assert _rows(t.latest(["vc_id", "process_status"], keys=keys), "vc_id", "process_status") == [("a", "成功")]
    t.write(spark.createDataFrame([("c", "成功", "v2")], schema), 1)  # replayed with other rows: the folder is replaced
    assert _rows(t.latest(), "vc_id", "process_status", "note") == [("a", "请求失败", "v0"), ("b", "成功", "v0"), ("c", "成功", "v2")]
