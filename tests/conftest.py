import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lantern import build_session

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.001")
