import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """DataFrame of text columns from rows."""

    def make(columns, *rows):
        return spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in columns))

    return make
