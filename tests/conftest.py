import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from zonalis.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.driver.host": "127.0.0.1"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = "/root/testdata"


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(f"{DATA}/sf0.001"):
        pytest.skip("no test tables")
    return f"{DATA}/sf0.001"
