"""Scale properties of the registered queries' physical plans."""

from __future__ import annotations

import pytest

from recsort.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

PYTHON_STAGES = ("MapInPandas", "MapInArrow", "FlatMapGroupsIn", "ArrowEvalPython", "BatchEvalPython")


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for k, fn in QUERIES.items():
        if k in ("ml_triage_score", "confusion_matrix", "embedding_head", "contrastive_pairs", "contrastive_score"):
            continue  # fits run jobs while planning; covered by their own tests
        out[k] = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_cartesian_products(plans):
    assert [k for k, p in plans.items() if "CartesianProduct" in p] == []


def test_no_nested_loop_joins(plans):
    assert [k for k, p in plans.items() if "BroadcastNestedLoopJoin" in p] == []


def test_no_python_on_the_hot_path(plans):
    """The responder's calls end in a journal, the contrastive fit is left out above; all else is built-in expressions."""
    assert sorted(k for k, p in plans.items() if any(s in p for s in PYTHON_STAGES)) == []


def test_text_not_read_when_not_needed(plans):
    for k in ("route_need_ai", "resume_pending", "retry_failed", "widen_schema", "sort_natural_id"):
        assert "text:string" not in plans[k], k


def test_last_write_wins_aggregates_partially(plans):
    assert "partial_max_by" in plans["last_write_wins"]
    assert "Window" not in plans["last_write_wins"]
