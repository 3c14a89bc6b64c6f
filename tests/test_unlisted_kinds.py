"""Accounts and scenarios outside the listed kinds lose no rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle.compare import differences
from tallyforge.sources.testdata import SampleTables

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
KEYS = ["gold_revenue_summary", "gold_ebitda_bridge", "gold_cash_flow_actual"]


@pytest.fixture(scope="module")
def changed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("unlisted"))
    for name in TABLES:
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        if name == "lineitem":
            status, key = F.col("l_linestatus"), F.col("l_orderkey") % 9
            rows = rows.withColumn("l_linestatus", F.when(status == "O", F.when(key < 8, "X")).otherwise(status))
            rows = rows.withColumn("l_returnflag", F.when(key == 1, "Q").when(key != 2, F.col("l_returnflag")))
        if name == "orders":
            key = F.col("o_orderkey") % 7
            rows = rows.withColumn("o_orderpriority", F.when(key == 0, "0-NEW").when(key != 1, F.col("o_orderpriority")))
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_every_journal_row_meets_its_dimensions(spark, changed):
    tables = SampleTables(spark, changed)
    gl, account, _, _, scenario = tables.star()
    joined = gl.join(account, "account_id").join(scenario, "scenario_id")
    kinds = {r.account_type for r in joined.select("account_type").distinct().collect()}
    assert joined.count() == gl.count() > 0 and "Unassigned" in kinds
    assert joined.where("scenario_name = 'Unassigned'").count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_results_equal_sql(spark, changed, key):
    got = entry.queries()[key](spark, changed)
    assert got.count() > 0
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{changed}/{name}.parquet/*.parquet')")
    assert differences(got, connection, entry.oracle_sql()[key]) == []
