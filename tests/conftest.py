import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sqlhaul.session import build_session

    s = build_session(
        "local[*]",
        app="sqlhaul-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sqlhaul-wh-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def lake(tmp_path):
    from sqlhaul import Lake

    return Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sf_dir():
    return SF0001
