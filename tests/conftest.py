import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from demandloom.plans.workspace import open_workspace  # noqa: E402
from demandloom.sources.storage import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def ws(spark):
    return open_workspace(spark, FOLDER)
