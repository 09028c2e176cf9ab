"""Calls to an outside service: isolation, retries, journal, names of calls."""

from __future__ import annotations

import glob
import json
import os
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recsort.constants import STATUS_OK, STATUS_REQUEST_FAIL
from recsort.operators import calls as K
from recsort.operators import classify as C

BODY = json.dumps({"choices": [{"message": {"content": "【违规类别】：x\n【判断理由】：y"}}]})


def _records(spark, texts, ids=None):
    ids = ids or [f"id{i}" for i in range(len(texts))]
    return spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "vc_id string, text_combined string, need_ai int").repartition(3)


def _counting(folder, fn):
    """``fn`` that leaves a file per call (tasks run in other processes)."""
    import os as o
    import uuid

    def call(request):
        text = json.loads(request)["messages"][1]["content"]
        with open(o.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(text)
        return fn(text)
    return call


def _made(folder):
    return sorted(open(f).read() for f in glob.glob(f"{folder}/*"))


def test_attempts_pauses_and_permanent_errors():
    seen = []

    def flaky(x):
        seen.append(time.monotonic())
        if len(seen) < 3:
            raise ConnectionError("refused")
        return x * 2
    assert K.persist(flaky, 4, timeout=5, attempts=3, backoff=0.05) == (8, None, 3)
    assert seen[1] - seen[0] >= 0.05 and seen[2] - seen[1] >= 0.1

    def rejected(x):
        raise K.PermanentError("bad request")
    assert K.persist(rejected, 1, 5, 4, 0.01) == (None, "PermanentError: bad request", 1)
    t = time.monotonic()
    assert K.persist(lambda x: time.sleep(2), 1, 0.1, 2, 0.01) == (None, K.TIMEOUT, 2)
    assert time.monotonic() - t < 1.5
    assert threading.active_count() < 50


def test_one_result_per_row_whatever_the_calls_do(spark):
    def service(request):
        text = json.loads(request)["messages"][1]["content"]
        if "raise" in text:
            raise ValueError("no")
        if "slow" in text:
            time.sleep(3)
        if "none" in text:
            return None
        return BODY if "odd" not in text else "{not json"
    texts = ["ok", "ok", "raise", "slow", "none", "odd", "ok 2", None]
    ids = ["a", "a", "a", "b", "c", None, "a", None]
    out = C.classify(_records(spark, texts, ids), None, C.CallResponder(service, timeout=0.5, attempts=2, backoff=0.01, calls_per_task=3), keep_reply=True).collect()
    assert len(out) == len(texts)
    got = sorted((r.vc_id or "", r.text_combined or "", r.process_status, r.error or "") for r in out)
    assert got == sorted([("a", "ok", STATUS_OK, "")] * 2 + [("a", "raise", STATUS_REQUEST_FAIL, "ValueError: no"), ("b", "slow", STATUS_REQUEST_FAIL, "timeout"),
                         ("c", "none", STATUS_REQUEST_FAIL, "no response"), ("", "odd", STATUS_REQUEST_FAIL, ""), ("a", "ok 2", STATUS_OK, ""), ("", "", STATUS_OK, "")])


def test_a_rerun_pays_only_for_what_has_no_reply(spark, tmp_dir):
    folder = f"{tmp_dir}/made"
    os.mkdir(folder)
    texts = [f"text {i}" for i in range(20)] + ["text 3"]
    rec = _records(spark, texts, [f"id{t}" for t in texts])

    def failing(text):
        if text.split()[2 if text.startswith("Classify") else 1].strip(".") in ("7", "8"):
            raise ConnectionError("down")
        return BODY
    fails = _counting(folder, lambda t: (_ for _ in ()).throw(ConnectionError("down")) if "text 7" in t else BODY)
    first = C.classify(rec, None, C.CallResponder(fails, attempts=1, calls_per_task=5, journal=f"{tmp_dir}/journal", run="r1"))
    assert first.filter(F.col("process_status") == STATUS_OK).count() == 20
    assert len(_made(folder)) == 20  # the repeated row shares a call
    works = _counting(folder, lambda t: BODY)
    again = C.classify(rec, None, C.CallResponder(works, calls_per_task=5, journal=f"{tmp_dir}/journal", run="r1"))
    assert again.filter(F.col("process_status") == STATUS_OK).count() == 21
    assert len(_made(folder)) == 21 and "text 7" in _made(folder)[-1] + "".join(_made(folder))
    other = C.classify(rec, None, C.CallResponder(works, calls_per_task=5, journal=f"{tmp_dir}/journal", run="r2"))
    assert other.count() == 21 and len(_made(folder)) == 41  # another run asks again


def test_outcomes_of_ended_tasks_survive_a_broken_job(spark, tmp_dir):
    folder = f"{tmp_dir}/made"
    os.mkdir(folder)
    rec = _records(spark, [f"text {i}" for i in range(40)])

    def dies(text):
        import os as o
        import time as t
        if "text 11" in text:
            t.sleep(1.5)  # until the other tasks have ended
            o._exit(1)
        return BODY
    with pytest.raises(Exception):
        C.classify(rec, None, C.CallResponder(_counting(folder, dies), timeout=30, calls_per_task=4, journal=f"{tmp_dir}/journal"))
    paid = spark.read.schema(K.JOURNAL).parquet(f"{tmp_dir}/journal").filter("error IS NULL").count()
    assert 0 < paid < 40
    before = len(_made(folder))
    out = C.classify(rec, None, C.CallResponder(_counting(folder, lambda t: BODY), calls_per_task=4, journal=f"{tmp_dir}/journal"))
    assert out.filter(F.col("process_status") == STATUS_OK).count() == 40
    assert len(_made(folder)) - before == 40 - paid


def test_waves_bound_the_tasks_at_a_time(spark, tmp_dir):
    rec = _records(spark, [f"text {i}" for i in range(30)])
    r = C.CallResponder(lambda request: BODY, calls_per_task=2, max_tasks=3, journal=f"{tmp_dir}/journal")
    assert C.classify(rec, None, r).filter(F.col("process_status") == STATUS_OK).count() == 30


def test_batches_hold_an_id_once_and_match_by_id(spark):
    def service(pdf: pd.DataFrame) -> pd.DataFrame:
        assert pdf["vc_id"].is_unique and len(pdf) <= 2
        if (pdf["vc_id"] == "bad").any():
            raise RuntimeError("batch")
        # out of order, one answer missing
        out = pd.DataFrame({"vc_id": pdf["vc_id"], "body": [json.dumps({"content": "【违规类别】：%d\n【判断理由】：y" % len(r)}) for r in pdf["request"]], "error": None})
        return out[out["vc_id"] != "short"].iloc[::-1]
    texts = ["t" * k for k in range(1, 8)] + ["x", "y"]
    ids = ["a"] * 4 + ["b", "b", "c", "short", "bad"]
    out = C.classify(_records(spark, texts, ids), None, C.PandasResponder(service, batch_rows=2, calls_per_task=100), keep_reply=True).collect()
    assert len(out) == len(texts)
    by = {(r.vc_id, r.text_combined): r for r in out}
    base = int(by[("a", "t")].ai_violation_categories) if by[("a", "t")].process_status == STATUS_OK else None
    for (i, t), r in by.items():
        if i == "short":
            assert r.error == "no response"
        elif r.process_status == STATUS_OK and base is not None:
            assert int(r.ai_violation_categories) == base + len(t) - 1
    assert by[("bad", "y")].error == "RuntimeError: batch"


def test_units_keep_ids_apart():
    r = C.PandasResponder(lambda p: p, batch_rows=3)
    calls = [(n, k, "r") for n, k in enumerate("aababcaadd")]
    units = r._units(calls)
    assert sorted(c for u in units for c in u) == calls
    assert all(len({c[1] for c in u}) == len(u) <= 3 for u in units)
