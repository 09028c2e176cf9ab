from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recsort.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="recsort-test-ckpt-")
    s = get_spark("local[4]", 4, app_name="recsort-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="recsort-test-")


def one_col(spark, values, name="x", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")
