import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_sql import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("4")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture
def make(spark):
    """Frame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def bag(df):
    """Rows as a sorted list, for comparing regardless of order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
