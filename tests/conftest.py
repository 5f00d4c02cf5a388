import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millwright.session import local_session

    return local_session(8, "tests")


@pytest.fixture
def ts(spark):
    """Rows with text timestamps cast to ``timestamp_ntz`` where the schema says so."""
    from pyspark.sql import functions as F

    def make(rows, schema):
        names = [c.split() for c in schema.split(", ")]
        raw = ", ".join(f"{n} {'string' if t in ('timestamp_ntz', 'date') else t}" for n, t in names)
        df = spark.createDataFrame(rows, raw)
        return df.select(*[F.col(n).cast(t).alias(n) for n, t in names])

    return make
