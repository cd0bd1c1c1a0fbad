import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from curatrix.session import build_session

    s = build_session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("wh")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
