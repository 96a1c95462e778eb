import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskframe.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("riskframe-tests", "local[4]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    # tests run without a cluster-provided checkpoint folder: set our own
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="riskframe-test-")
