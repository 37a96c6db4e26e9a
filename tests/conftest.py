import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textsieve.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="textsieve-test-")


def one_col(spark, values, name="t"):
    from pyspark.sql import types as T

    return spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                                 T.StructType([T.StructField("i", T.LongType()), T.StructField(name, T.StringType())]))


def evaluate(spark, values, expr, name="t"):
    """Apply a Column expression to a one-column table; results in input order."""
    df = one_col(spark, values, name)
    return [r[0] for r in df.orderBy("i").select(expr).collect()]
