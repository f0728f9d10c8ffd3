import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from panelspark.session import local_session

    session = local_session("tests", cores=4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Small table from a list of tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
