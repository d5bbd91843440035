import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from korpusmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Results of a Column function over a list of values, in order."""

    def run(function, values, ddl="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {ddl}")
        return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]

    return run
