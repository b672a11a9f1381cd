import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textpulse.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Value of a column expression for each of some texts."""
    def values(expression, texts, name="x"):
        from pyspark.sql import functions as F
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, {name} string")
        return [r[0] for r in df.orderBy("i").select(expression(F.col(name))).collect()]
    return values
