import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vitrine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("vitrine-tests", "8", "6g", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Value of a Column over a single row of literals."""
    def evaluate(column, **values):
        from pyspark.sql import functions as F
        df = spark.range(1)
        for name, value in values.items():
            df = df.withColumn(name, F.lit(value))
        return df.select(column.alias("x")).first().x
    return evaluate
