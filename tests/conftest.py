import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from encore.session import build_session
    scratch = tempfile.mkdtemp(prefix="encore-test-")
    s = build_session("local[4]", 4, "encore-tests", extra={"spark.checkpoint.dir": f"{scratch}/ckpt"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="encore-case-")
