"""CSV files in UTF-8, UTF-8 with BOM, GBK and GB18030, read per file."""

from __future__ import annotations

import os

import pytest

from recsort.sources.csv import (
    SCORING_ENCODINGS,
    TRAINING_ENCODINGS,
    CharsetError,
    detect_charsets,
    normalise_nulls,
    read_records,
    require_columns,
)

HEADER = "vc_id,text_combined,need_ai,violation_categories\n"
BODY = ('A-1,"a, b",1,NA\n'
        'A-2,"line one\nline two",0,null\n'
        'A-3,"say ""hi"" 你好",1,\n')


def _write(dirpath, name, text, enc, bom=b""):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "wb") as f:
        f.write(bom + text.encode(enc))


@pytest.fixture
def f3(tmp_dir):
    _write(tmp_dir, "u8.csv", HEADER + BODY, "utf-8")
    _write(tmp_dir, "u8bom.csv", HEADER + BODY.replace("A-", "B-"), "utf-8", bom=b"\xef\xbb\xbf")
    _write(tmp_dir, "gbk.csv", HEADER + BODY.replace("A-", "C-"), "gbk")
    # a four-byte GB18030 character (outside GBK)
    _write(tmp_dir, "gb18030.csv", HEADER + BODY.replace("A-", "D-").replace("你好", "你好\U00020000"), "gb18030")
    return tmp_dir


def test_detect_per_file(spark, f3):
    got = {os.path.basename(r.path): r.charset for r in detect_charsets(spark, f3).collect()}
    assert got == {"u8.csv": "utf-8", "u8bom.csv": "utf-8", "gbk.csv": "gbk", "gb18030.csv": "gb18030"}


def test_training_order_picks_gbk_before_gb18030(spark, f3):
    got = {os.path.basename(r.path): r.charset for r in detect_charsets(spark, f3, TRAINING_ENCODINGS).collect()}
    assert got["gbk.csv"] == "gbk" and got["gb18030.csv"] == "gb18030"


def test_read_all_charsets_with_quotes_and_nulls(spark, f3):
    df = read_records(spark, f3, SCORING_ENCODINGS)
    assert sorted(df.columns) == ["need_ai", "text_combined", "vc_id", "violation_categories"]
    rows = {r.vc_id: r for r in df.collect()}
    assert len(rows) == 12
    for p in "ABCD":
        assert rows[f"{p}-1"].text_combined == "a, b"
        assert rows[f"{p}-2"].text_combined == "line one\nline two"
        assert rows[f"{p}-1"].violation_categories is None  # NA
        assert rows[f"{p}-2"].violation_categories is None  # null
        assert rows[f"{p}-3"].violation_categories is None  # empty
    assert rows["A-3"].text_combined == 'say "hi" 你好'
    assert rows["D-3"].text_combined == 'say "hi" 你好\U00020000'


def test_keep_null_tokens_as_text(spark, f3):
    df = read_records(spark, f3, null_tokens=None)
    assert {r.violation_categories for r in df.collect()} >= {"NA", "null"}


def test_pruned_read(spark, f3):
    df = read_records(spark, f3, columns=["vc_id", "need_ai"])
    assert df.columns == ["vc_id", "need_ai"] and df.count() == 12


def test_missing_column_lists_available(spark, f3):
    df = read_records(spark, f3)
    with pytest.raises(ValueError, match="available columns"):
        require_columns(df, ["text"])


def test_undecodable_file_raises(spark, tmp_dir):
    _write(tmp_dir, "bad.csv", "", "utf-8", bom=b"a,b\n\xff\xfe\xfd\x80\n")
    with pytest.raises(CharsetError):
        read_records(spark, tmp_dir, ("utf-8",))


def test_normalise_nulls_token_list(spark):
    df = spark.createDataFrame([("NA",), ("N/A",), ("nan",), ("None",), ("ok",), ("",)], "x string")
    assert [r.x for r in normalise_nulls(df, ["x"]).collect()] == [None, None, None, None, "ok", None]


def test_write_records_roundtrip_keeps_cells(spark, tmp_dir):
    from recsort.sinks.results import write_records
    rows = [("a", " lead", "trail ", "x,\ny"), ("b", "\tboth\t", 'q"q', None)]
    df = spark.createDataFrame(rows, "vc_id string, c1 string, c2 string, c3 string")
    write_records(df, f"{tmp_dir}/out")
    back = read_records(spark, f"{tmp_dir}/out", null_tokens=None)
    assert sorted(tuple(r) for r in back.select("vc_id", "c1", "c2", "c3").collect()) == sorted(rows)


def test_files_are_joined_by_column_name(spark, tmp_dir):
    _write(tmp_dir, "a.csv", "vc_id,text_combined\nA-1,hello\nA-2,你\n", "utf-8")
    _write(tmp_dir, "b.csv", "text_combined,vc_id,extra\nworld,B-1,e\n", "gbk")
    _write(tmp_dir, "c.csv", "text_combined,vc_id\r\n\"two\r\nlines\",C-1\r\n", "utf-8", bom=b"\xef\xbb\xbf")
    got = {r.vc_id: (r.text_combined, r.extra) for r in read_records(spark, tmp_dir).collect()}
    assert got == {"A-1": ("hello", None), "A-2": ("你", None), "B-1": ("world", "e"), "C-1": ("two\nlines", None)}


def test_charset_is_decided_over_all_splits_of_a_file(spark, tmp_dir):
    """One bad line near the end of a file of many splits; the splits' results meet per file."""
    body = "vc_id,text_combined\n" + "".join(f"A-{i},{'x' * 200}\n" for i in range(4000))
    _write(tmp_dir, "a.csv", body, "utf-8")
    _write(tmp_dir, "b.csv", body.replace("A-", "B-") + "B-last,你好\n", "gbk")
    _write(tmp_dir, "d.csv", body.replace("A-", "D-") + "D-last,\U00020000\n", "gb18030")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(100_000))
    try:
        found = detect_charsets(spark, tmp_dir)
        assert found.select("path").count() == 3 and {os.path.basename(r.path): (r.charset, r.split) for r in found.collect()} == {
            "a.csv": ("utf-8", True), "b.csv": ("gbk", True), "d.csv": ("gb18030", True)}
        df = read_records(spark, tmp_dir, order_col="at")
        assert df.rdd.getNumPartitions() > 10
        rows = df.orderBy("at").collect()
        assert [r.vc_id for r in rows if r.vc_id.startswith("B-")] == [f"B-{i}" for i in range(4000)] + ["B-last"]
        assert {r.vc_id: r.text_combined for r in rows if r.vc_id.endswith("last")} == {"B-last": "你好", "D-last": "\U00020000"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_gbk_needs_every_line_to_decode(spark, tmp_dir):
    """A line that is UTF-8 by itself but not GBK rules GBK out for the whole file."""
    _write(tmp_dir, "a.csv", "", "utf-8", bom="vc_id,t\n1,".encode() + "\U00020000".encode("gb18030") + b"\n2," + "\u00e9".encode("utf-8") + b"\n")
    got = detect_charsets(spark, tmp_dir).first()
    assert got.charset in (None, "gb18030")


def test_no_files(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_records(spark, f"{tmp_dir}/none")
    with pytest.raises(FileNotFoundError):
        read_records(spark, tmp_dir)
