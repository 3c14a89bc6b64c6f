import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = f"/tmp/tallyforge-tests-{__import__('uuid').uuid4().hex}"
    session = local_session(8, "tests", {"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Frame from tuples and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
