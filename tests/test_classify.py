"""Responder boundary, end-to-end classification, merge, streaming restart."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from recsort.constants import STATUS_OK, STATUS_PARSE_FAIL, STATUS_REQUEST_FAIL
from recsort.operators import classify as C
from recsort.operators import state as S
from recsort.sinks.results import BatchResults
from recsort.sources import fixtures as FX
from recsort.streaming.incremental import batch_writer, run_available
from tests.conftest import SF_SMALL


def test_pandas_responder_statuses(spark):
    # defined here so the worker receives it by value
    def fake_service(pdf: pd.DataFrame) -> pd.DataFrame:
        """Stands in for an HTTP client: a reply, a timeout, or an odd body."""
        bodies, errors = [], []
        for vc_id, req in zip(pdf["vc_id"], pdf["request"]):
            prompt = json.loads(req)["messages"][1]["content"]
            h = sum(map(ord, vc_id)) % 3
            if h == 0:
                bodies.append(json.dumps({"choices": [{"message": {"content": f"【违规类别】：x\n【判断理由】：{len(prompt)}"}}]}))
                errors.append(None)
            elif h == 1:
                bodies.append(None)
                errors.append("timeout")
            else:
                bodies.append(json.dumps({"response": "no sections"}))
                errors.append(None)
        return pd.DataFrame({"vc_id": pdf["vc_id"], "body": bodies, "error": errors})

    rec = FX.f2_records(spark, SF_SMALL)
    out = C.classify(rec, None, C.PandasResponder(fake_service, concurrency=3), mode="new")
    got = {r.process_status for r in out.collect()}
    assert got <= {STATUS_OK, STATUS_REQUEST_FAIL, STATUS_PARSE_FAIL}
    assert out.count() == S.route_need_ai(rec).count()
    fails = out.filter(F.col("process_status") == STATUS_REQUEST_FAIL)
    assert fails.filter("ai_raw_response != ''").count() == 0


def test_unanswered_records_are_request_failures(spark):
    def first_only(pdf: pd.DataFrame) -> pd.DataFrame:
        body = json.dumps({"choices": [{"message": {"content": "【违规类别】：x\n【判断理由】：y"}}]})
        return pd.DataFrame({"vc_id": pdf["vc_id"], "body": body, "error": None}).astype({"error": object}).head(1)

    rec = FX.f2_records(spark, SF_SMALL)
    out = C.classify(rec, None, C.PandasResponder(first_only, concurrency=1), mode="new", keep_reply=True).collect()
    want = S.route_need_ai(rec).count()
    failed = [r for r in out if r.process_status == STATUS_REQUEST_FAIL]
    assert len(out) == want and 0 < len(failed) < want
    assert all(r.error == "no response" and r.ai_reason == STATUS_REQUEST_FAIL and r.ai_raw_response == "" for r in failed)


def test_retry_mode_needs_prior(spark):
    import pytest
    with pytest.raises(ValueError):
        C.classify(FX.f2_records(spark, SF_SMALL), None, C.RuleResponder(FX.keywords_df(spark)), mode="retry")


def test_rule_responder_end_to_end(spark):
    rec = FX.f2_records(spark, SF_SMALL)
    rows = C.classify(rec, FX.f6_prior(spark, SF_SMALL), C.RuleResponder(FX.keywords_df(spark)), mode="new")
    st = {r.process_status for r in rows.collect()}
    assert st == {STATUS_OK}
    assert rows.count() == S.resume_pending(rec, FX.f6_prior(spark, SF_SMALL)).count()


def test_merge_priority(spark):
    base = spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id long")
    ai = spark.createDataFrame([(1, "A", STATUS_OK), (2, STATUS_PARSE_FAIL, STATUS_PARSE_FAIL)],
                               "doc_id long, ai_violation_categories string, process_status string")
    dic = spark.createDataFrame([(1, "D"), (2, "D"), (3, "")], "doc_id long, categories string")
    rules = spark.createDataFrame([(1, "R"), (2, "R"), (3, "R"), (4, "其他违法行为")], "doc_id long, rule_categories string")
    got = {r.doc_id: (r.final_categories, r.source) for r in C.merge_results(base, ai, dic, rules).collect()}
    assert got == {1: ("A", "expert"), 2: ("D", "dictionary"), 3: ("R", "rule"), 4: ("其他违法行为", "fallback")}


def test_merge_parses_replies_once(spark):
    """The filter on the status is not tried below the join on the reply's patterns; repeated and missing keys stay as they were."""
    from recsort.functions.replies import with_parsed_reply
    base = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).alias("doc_id"), F.lit("R").alias("rule_categories"))
    reply = F.when(F.col("id") != 1, F.concat(F.lit("【违规类别】：c"), F.col("id"), F.lit("【判断理由】：r")))
    once = spark.range(4).select(F.col("id").alias("doc_id"), reply.alias("reply"))
    ai = with_parsed_reply(once.unionByName(once.filter("doc_id in (1, 3)")), "reply")
    dic = spark.createDataFrame([(1, "D")], "doc_id long, categories string")
    one = C.merge_results(base, with_parsed_reply(once, "reply"), dic)
    assert one._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1
    got = sorted((str(r.doc_id), r.final_categories, r.source) for r in C.merge_results(base, ai, dic).collect())
    assert got == [("0", "c0", "expert"), ("1", "D", "dictionary"), ("2", "c2", "expert"), ("3", "c3", "expert"), ("3", "c3", "expert"), ("None", "R", "rule")]


def test_stream_restart_equals_one_batch(spark, tmp_dir):
    rec = FX.f2_records(spark, SF_SMALL)
    responder = C.RuleResponder(FX.keywords_df(spark))
    src, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    table = BatchResults(spark, f"{tmp_dir}/results")
    first = F.col("doc_id") % 2 == 0
    rec.filter(first).write.parquet(f"{src}/arrival=1")
    run_available(spark, src, rec.schema, table, ckpt, responder)
    n1 = table.latest().count()
    rec.filter(~first).write.parquet(f"{src}/arrival=2")
    run_available(spark, src, rec.schema, table, ckpt, responder)
    assert table.batches() == [0, 1]
    run_available(spark, src, rec.schema, table, ckpt, responder)  # nothing new: no batch
    assert table.batches() == [0, 1]
    rows = lambda df: sorted(tuple(r) for r in df.select("vc_id", "process_status", "ai_violation_categories").collect())
    once = rows(C.classify(rec, None, responder, mode="new"))
    assert 0 < n1 < len(once)
    assert rows(table.latest()) == once
    # a batch that is run again after a crash replaces its folder
    batch_writer(table, responder)(rec.filter(~first), 1)
    assert table.batches() == [0, 1] and rows(table.latest()) == once


def test_event_log_one_pass_shape(spark):
    rows = spark.createDataFrame(
        [("a", "txt", "permissive", None, "R", "A", "r", "成功"),
         ("b", None, None, "timeout", None, "请求失败", "请求失败", "请求失败")],
        "vc_id string, text_combined string, violation_categories string, error string, reply string, "
        "ai_violation_categories string, ai_reason string, process_status string")
    ev = {(r.vc_id, r.event): r for r in C.event_log(rows).collect()}
    assert sorted(ev) == [("a", "request"), ("a", "response"), ("b", "error"), ("b", "request")]
    assert ev[("a", "request")].prompt == "Known: permissive. Classify: txt. Recheck: permissive"
    assert ev[("a", "request")].text_len == 3 and ev[("b", "request")].text_len == 0
    assert ev[("a", "response")].status == "成功" and ev[("a", "response")].raw_response == "R"
    assert ev[("b", "error")].error == "timeout" and ev[("b", "error")].status is None


def test_rule_responder_paths_agree(spark):
    rec = S.route_need_ai(FX.f2_records(spark, SF_SMALL))
    responder = C.RuleResponder(FX.keywords_df(spark))
    # only the JSON body: the responder must read the prompt back out of it
    via_json = responder(C.requests_for(rec).select("vc_id", "request"), "vc_id").select("vc_id", "body")
    via_rows = responder.respond_rows(C.with_requests(rec)).select("vc_id", "body")
    a = sorted(tuple(r) for r in via_json.collect())
    b = sorted(tuple(r) for r in via_rows.collect())
    assert a == b and len(a) == rec.count()
