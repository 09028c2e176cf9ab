"""The three user-level jobs end to end on CSV files."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from recsort.constants import STATUS_OK, STATUS_REQUEST_FAIL
from recsort.operators import classify as C
from recsort.plans import jobs as J
from recsort.sinks.results import KeyedResults
from recsort.sources import fixtures as FX
from recsort.sources.export import export_encoded_records
from tests.conftest import SF_SMALL


def _responder(fail_every: int):
    def service(pdf: pd.DataFrame) -> pd.DataFrame:
        bodies, errors = [], []
        for vc_id in pdf["vc_id"]:
            if fail_every and sum(map(ord, vc_id)) % fail_every == 0:
                bodies.append(None)
                errors.append("timeout")
            else:
                bodies.append(json.dumps({"choices": [{"message": {"content": "【违规类别】：x\n【判断理由】：y"}}]}))
                errors.append(None)
        return pd.DataFrame({"vc_id": pdf["vc_id"], "body": bodies, "error": errors})
    return service


def test_train_score_classify_retry(spark, tmp_dir):
    train_csv = export_encoded_records(spark, FX.f1_training(spark, SF_SMALL), f"{tmp_dir}/train")
    stats = J.train_job(spark, train_csv, f"{tmp_dir}/model", max_iter=5)
    assert stats["distribution"].count() == 2 and stats["rejects"].count() > 0

    records = FX.f2_records(spark, SF_SMALL).drop("need_ai")
    score_csv = export_encoded_records(spark, records, f"{tmp_dir}/score_in")
    st = J.score_job(spark, score_csv, f"{tmp_dir}/scored", f"{tmp_dir}/model").first()
    assert st.n_total == records.count() and st.n_need_ai + st.n_no_ai == st.n_total

    scored = f"{tmp_dir}/scored"
    routed = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .csv(scored).filter(F.col("need_ai") == "1").count()
    results = f"{tmp_dir}/results"
    first = {r.process_status: r.n_rows for r in J.classify_job(
        spark, scored, results, C.PandasResponder(_responder(3), concurrency=2)).collect()}
    assert sum(first.values()) == routed and first.get(STATUS_REQUEST_FAIL, 0) > 0

    # new mode again: everything has a status, nothing to do
    again = J.classify_job(spark, scored, results, C.PandasResponder(_responder(0)))
    assert again.count() == 0

    # retry mode: only the failures are sent again, now they succeed
    retry = {r.process_status: r.n_rows for r in J.classify_job(
        spark, scored, results, C.PandasResponder(_responder(0)), mode="retry",
        events_path=f"{tmp_dir}/events").collect()}
    assert retry == {STATUS_OK: first[STATUS_REQUEST_FAIL]}
    events = spark.read.json(f"{tmp_dir}/events")
    kinds = {r.event: r["count"] for r in events.groupBy("event").count().collect()}
    assert kinds == {"request": first[STATUS_REQUEST_FAIL], "response": first[STATUS_REQUEST_FAIL]}
    table = KeyedResults(spark, f"{results}/table").read()
    assert table.count() == routed
    assert table.filter(F.col("process_status") != STATUS_OK).count() == 0
