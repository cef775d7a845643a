import os

import pytest

from fieldmark import get_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    from checks.run import connect

    return connect(sf_dir)
