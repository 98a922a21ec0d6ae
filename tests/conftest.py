import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    return local_session(memory="8g")


@pytest.fixture
def make(spark):
    """Frame from rows and a schema string, spread over several partitions."""
    def build(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return build
