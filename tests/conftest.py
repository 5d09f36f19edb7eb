import os
import sys
import tempfile
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cubelake.session import get_spark

    s = get_spark("local[4]", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder under the session's shared root (never reused)."""
    from cubelake.session import scratch_dir

    path = scratch_dir(spark, "test")
    os.makedirs(path, exist_ok=True)
    return path


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix=f"cubelake-test-{uuid.uuid4().hex[:6]}-")
