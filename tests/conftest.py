import os

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from siltstone.session import build

    session = build("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


DATA = "/root/testdata"


@pytest.fixture(scope="session")
def small():
    folder = f"{DATA}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    return folder
