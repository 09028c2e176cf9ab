"""Reply extraction and parsing: one case per trap (hand-computed)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from recsort.constants import STATUS_OK, STATUS_PARSE_FAIL, STATUS_REQUEST_FAIL
from recsort.functions.replies import with_extracted_reply, with_parsed_reply

OK, PF, RF = STATUS_OK, STATUS_PARSE_FAIL, STATUS_REQUEST_FAIL

CASES = [
    # (reply, category, reason, status)
    ("【违规类别】：A||B\n【判断理由】：why\nmore", "A||B", "why more", OK),
    ("【违规类别】: A\n【判断理由】: one\n\n\rtwo ", "A", "one two", OK),
    # position wins over the tag names
    ("【判断理由】：first\n【违规类别】：second", "first", "second", OK),
    ("违规类别：A判断理由：plain", "A", "plain", OK),
    # bare label stops before the judge word
    ("违规类别：A 判断一下", "A", PF, PF),
    ("【违规类别】：A", "A", PF, PF),
    ("", PF, PF, PF),
    ("nothing to see", PF, PF, PF),
    # the first pattern that matches wins even when its body is blank
    # (the short label would have found 'B')
    ("理由：r\n类别：B\n【违规类别】：　\n", PF, "r 类别：B", PF),
    # short labels: the category body runs to the next bracket or the end
    ("类别：C\n理由：because", "C理由：because", "because", OK),
    # one section only; bracketed category pattern has no judge-word stop
    ("【违规类别】：A\n判断理由：late", "A判断理由：late", "late", OK),
    # Python $ also matches before one final newline; category line breaks deleted
    ("【违规类别】：A\nB\n【判断理由】：r\n", "AB", "r", OK),
    # a reply that literally says the failure word is a failure
    (f"【违规类别】：{PF}\n【判断理由】：r", PF, "r", PF),
    # full-width and half-width colons, unicode whitespace around bodies
    ("【违规类别】:　X　【判断理由】：\xa0Y\xa0", "X", "Y", OK),
]


@pytest.mark.parametrize("reply,cat,reason,status", CASES)
def test_parse_reply_table(spark, reply, cat, reason, status):
    df = spark.createDataFrame([(reply,)], "reply string")
    r = with_parsed_reply(df, "reply").first()
    assert (r.ai_violation_categories, r.ai_reason, r.process_status) == (cat, reason, status)
    assert r.ai_raw_response == reply[:500]


def test_raw_reply_cut_counts_code_points(spark):
    reply = "\U0001F600" * 499 + "ab"
    r = with_parsed_reply(spark.createDataFrame([(reply,)], "reply string"), "reply").first()
    assert r.ai_raw_response == "\U0001F600" * 499 + "a"


def test_transport_failure_row(spark):
    df = spark.createDataFrame([("x", "timeout"), (None, None)], "reply string, error string")
    rows = with_parsed_reply(df, "reply", F.col("error").isNull()).collect()
    for r in rows:
        assert (r.ai_violation_categories, r.ai_reason, r.ai_raw_response, r.process_status) == (RF, RF, "", RF)


def test_suffix_columns(spark):
    df = spark.createDataFrame([("【违规类别】：A\n【判断理由】：r",)], "reply string")
    r = with_parsed_reply(df, "reply", suffix="_v2").first()
    assert r.process_status_v2 == OK and r.ai_violation_categories_v2 == "A"


BODIES = [
    (json.dumps({"choices": [{"message": {"content": "hi"}}]}), "hi"),
    (json.dumps({"choices": [{"message": {"content": None}}]}), None),
    (json.dumps({"choices": [{"message": {}}]}), ""),
    (json.dumps({"choices": [{}]}), ""),
    (json.dumps({"choices": [{"message": {"content": 5}}]}), None),
    (json.dumps({"choices": [], "response": "r"}), "r"),
    (json.dumps({"choices": []}), '{"choices":[]}'),
    (json.dumps({"response": None}), None),
    (json.dumps({"content": "c"}), "c"),
    (json.dumps({"response": "r", "content": "c"}), "r"),
    (json.dumps({"choices": ["x"]}), None),
    (json.dumps({"choices": "abc"}), None),
    (json.dumps({"choices": ""}), '{"choices":""}'),
    ("not json", None),
    (json.dumps(["a"]), '["a"]'),
    (json.dumps(["choices"]), None),
    (json.dumps("【违规类别】：x【判断理由】：y"), "【违规类别】：x【判断理由】：y"),
    (json.dumps("no choices here"), None),
    (json.dumps(5), None),
    (None, None),
    (json.dumps({"other": 1}), '{"other":1}'),
]


@pytest.mark.parametrize("body,text", BODIES)
def test_extract_reply_shapes(spark, body, text):
    df = spark.createDataFrame([(body,)], "body string")
    r = with_extracted_reply(df, "body").first()
    assert r.reply_text == text
    assert r.reply_ok == (text is not None)
