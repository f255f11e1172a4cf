import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import prepare

    session = (
        SparkSession.builder.master("local[8]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    from oracle import connect

    return connect(DATA)
