import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keelson.session import get_session
    s = get_session("keelson-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="keelson-wh-"),
    })
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="keelson-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
