import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cardfile.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    old = {}

    def set_(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def values(spark):
    """Results of one column expression over a list of strings."""
    from pyspark.sql import functions as F

    def run(expr, inputs):
        rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
        return [r[1] for r in rows.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
