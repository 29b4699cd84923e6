import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from larkframe.session import local_session

    s = local_session("*", "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from larkframe.tables import Tables

    return Tables(spark, SMALL)
