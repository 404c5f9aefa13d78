import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestep.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]", "tests", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Values of a column expression over the texts given, in order."""
    from pyspark.sql import functions as F

    def evaluate(expression, texts, kind="string"):
        rows = spark.createDataFrame(list(enumerate(texts)), f"i int, v {kind}")
        return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]
    return evaluate
