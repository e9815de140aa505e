import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    """A fresh scratch folder per test session (never cleared, never reused)."""
    return subprocess.check_output(["mktemp", "-d", "/tmp/run-XXXXXX"], text=True).strip()


@pytest.fixture(scope="session")
def spark(scratch):
    from quarry.session import build_session

    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
    }
    session = build_session("local[*]", app_name="quarry-tests", conf=conf)
    session.sparkContext.setLogLevel("ERROR")
    # Set a checkpoint folder only where the environment gives none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    from quarry.session import new_work_dir

    return new_work_dir(spark, "test")
