import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridmart.session import build_session  # noqa: E402



@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="gridmart-tests-")
    s = build_session(
        master="local[4]",
        app_name="gridmart-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.sql.warehouse.dir": f"{scratch}/wh"},
    )
    s.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="gridmart-case-")
