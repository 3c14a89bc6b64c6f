import pytest

import __spark_entry__ as entry
from oracle.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
# The text queries have tests of their own.
QUERIES = {k: q for k, q in entry.queries().items() if k not in entry.TEXT_QUERIES}
SQL = {k: s for k, s in entry.oracle_sql().items() if k not in entry.TEXT_SQL}
# Results of a trained model or of the clock have no SQL counterpart.
UNCHECKED = {"ml_train", "ml_cv_metrics", "ml_feature_importance", "ml_attribution", "forecast_intervals", "ml_revenue_forecast"}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) - set(SQL) == UNCHECKED
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_equal_rows(spark, connection, key):
    assert differences(QUERIES[key](spark, FOLDER), connection, SQL[key]) == []


@pytest.mark.parametrize("key", sorted(UNCHECKED))
def test_model_queries_run(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
