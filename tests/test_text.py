"""Text cleaners: Unicode whitespace, 'nan', rule categories, natural sort."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recsort.functions import text as T
from tests.conftest import one_col

WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


def test_strip_u_matches_python_strip_on_all_whitespace(spark):
    vals = [WS + "a b" + WS, "　x　", "\xa0", "", None, "​keep​"]
    got = [r[0] for r in one_col(spark, vals).select(T.strip_u("x")).collect()]
    assert got == [v.strip() if v is not None else None for v in vals]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(WS) + list("ab|N")), max_size=12), min_size=1, max_size=8))
def test_strip_u_property(spark, vals):
    got = [r[0] for r in one_col(spark, vals).select(T.strip_u("x")).collect()]
    assert got == [v.strip() for v in vals]


def test_clean_text_rules(spark):
    vals = [None, "  NaN ", "nan", "Nan　", " text ", "nana"]
    got = [r[0] for r in one_col(spark, vals).select(T.clean_text("x")).collect()]
    assert got == ["", "", "", "", "text", "nana"]


def test_clean_rule_categories(spark):
    vals = [
        None, "nan", "permissive || copyleft", " permissive||其他违法行为|| ",
        "其他违法行为", "\tcopyleft||||copyleft ", "a　||　b", "a|b||c",
    ]
    got = [r[0] for r in one_col(spark, vals).select(T.clean_rule_categories("x")).collect()]
    assert got == ["", "", "permissive||copyleft", "permissive", "", "copyleft||copyleft", "a||b", "a|b||c"]


def test_flatten_is_one_to_one(spark):
    got = one_col(spark, ["a\r\n\tb\n\n"]).select(T.flatten_ws("x")).first()[0]
    assert got == "a   b  "


def test_preview_counts_code_points(spark):
    s = "\U0001F600" * 3 + "\nxyz"
    got = one_col(spark, [s]).select(T.preview(F.col("x"), 5)).first()[0]
    assert got == "\U0001F600" * 3 + " x"


def test_fold_width(spark):
    got = one_col(spark, ["ＡＢＣ１２３（）　x"]).select(T.fold_width(F.col("x"))).first()[0]
    assert got == "ABC123() x"


def _py_natural(ids):
    import re

    def num(v):
        m = re.search(r"(\d+)", str(v))
        return int(m.group(1)) if m else 0
    return sorted(ids, key=lambda v: (num(v), v))


def test_natural_sort_exact_for_long_and_odd_ids(spark):
    ids = ["A-007", "A-7", "B-10", "x", "", "A-0", "9" * 45, "1" + "0" * 44, "A-00", "Z-2b3", "b-2"]
    rng = random.Random(7)
    ids += [f"{rng.choice('AB')}-{'0' * rng.randint(0, 3)}{rng.randint(0, 10**6)}" for _ in range(200)]
    df = one_col(spark, ids, "vc_id")
    n_len, z = T.natural_key(F.col("vc_id"))
    got = [r[0] for r in df.orderBy(n_len, z, "vc_id").collect()]
    assert got == _py_natural(ids)
