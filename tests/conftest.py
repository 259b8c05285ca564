import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import TESTDATA  # noqa: E402
from pulseforge import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture
def tables(tmp_path):
    from pulseforge.sources.tables import Tables

    return Tables(str(tmp_path / "tables"))
