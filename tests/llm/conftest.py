import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_cases import SCHEMA, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """The rows as a stored table, in two files."""
    from recoengine.session import prepare, scratch_path
    prepare(spark)
    path = scratch_path(spark, "edge")
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    from recoengine.session import prepare, scratch_path
    prepare(spark)
    path = scratch_path(spark, "nothing")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
