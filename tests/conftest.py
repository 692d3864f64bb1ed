from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.session import build_session  # noqa: E402

SF_DIR = os.environ.get("ORDERMILL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="ordermill-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ordermill-tests-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ordermill-warehouse-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
