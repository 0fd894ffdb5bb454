import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexitab.session import local_session

    session = local_session(8, "tests", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make ``(title, value, ord)`` rows in the given order, spread over a few partitions."""
    def make(pairs, parts=3):
        data = [(t, v, i) for i, (t, v) in enumerate(pairs)]
        return spark.createDataFrame(data, "title string, value string, ord bigint").repartition(parts)
    return make
