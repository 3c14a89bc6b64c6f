import threading
import uuid
from pathlib import Path
from shutil import copyfile

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import forecast as fc
from tallyforge.plans.boosting import BoostedTrees
from tallyforge.plans.medallion import GOLD_TABLES, build_bronze, build_silver, model_path, run_all
from tallyforge.plans.metrics import METRIC_VIEWS
from tallyforge.plans.questions import QUESTIONS
from tallyforge.plans.reports import REPORTS, ReportFilter, report
from tallyforge.sources.feeds import FEEDS
from tallyforge.sources.files import read_csv, write_csv
from tallyforge.sources.testdata import SampleTables, bronze_rows
from tallyforge.sources.warehouse import Warehouse, table_inventory

SMALL = "/root/testdata/sf0.001"


def test_landing_to_forecast(spark):
    root = Path(f"/tmp/tallyforge-run-{uuid.uuid4().hex}")
    samples = SampleTables(spark, SMALL)
    for name, feed in FEEDS.items():
        rows = bronze_rows(samples, feed).select(*[c for c, _ in feed.columns])
        write_csv(rows.coalesce(1), str(root / "made" / name))
        (root / "landing").mkdir(exist_ok=True)
        part = next((root / "made" / name).glob("part-*.csv"))
        copyfile(part, root / "landing" / feed.glob.replace("*", "_2024"))
    house = Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}")
    places = (spark, str(root / "landing"), str(root / "bronze"))
    params = fc.TreeParams(trees=3, depth=3, min_rows_per_leaf=1)
    # The sample's customer and brand pairs are too short for a yearly lag.
    counts = run_all(*places, house, params, ("business_unit", "region", "product_family"))
    assert len(counts) == 16 and all(c["rows"] > 0 for c in counts.values())
    assert counts["silver_fact_orders"]["positive_qty"] == 0
    names = [f.silver_table for f in FEEDS.values()] + [s.name for s in GOLD_TABLES]
    inventory = table_inventory(spark, house, [*names, "silver_nothing"]).collect()
    assert {r.table_name for r in inventory if not r.found} == {"silver_nothing"}
    assert all(r.row_count > 0 for r in inventory if r.found)
    assert house["ml_revenue_forecast"].count() % 18 == 0
    expected = samples["gold_order_backlog"].count()
    assert house["gold_order_backlog"].count() == expected
    trend = report("q_rev_quarter_trend", house, ReportFilter(fiscal_year=2000))
    assert trend.count() > 0
    asked = house.query(
        "SELECT count(*) AS n FROM {gold_order_backlog} WHERE region = :region", region="ASIA' OR 1=1 --"
    )
    assert asked.first().n == 0
    orphans = house["fk_orphan_report"]
    assert orphans.where("check_name = 'silver_fact_orders.entity_id'").first().orphan_rows == 0
    assert orphans.count() > 20
    assert {r.fold for r in house["ml_cv_metrics"].collect()} == {1, 2, 3, None}
    assert house["ml_feature_importance"].count() == len(fc.FEATURES)
    assert len(BoostedTrees.load(spark, model_path(house)).trees) == 3
    for name in REPORTS:
        if name.startswith("forecast_"):
            assert report(name, house, ReportFilter()).count() > 0
    assert QUESTIONS["nlq_top_family"](house).count() > 0
    view = METRIC_VIEWS["mv_forecast_accuracy"]
    assert view.query(house, ["Region"]).count() == house.query(view.statement(["Region"])).count() > 0
    same = METRIC_VIEWS["mv_ebitda"]
    asked = house.query(same.statement(["Region"], ["EBITDA Margin"])).collect()
    assert sorted(asked) == sorted(same.query(house, ["Region"], ["EBITDA Margin"]).collect())
    # A rebuild from the same landing zone changes nothing.
    before = house["silver_fact_orders"].count()
    build_silver(house, build_bronze(*places), ["orders"])
    assert house["silver_fact_orders"].count() == before
    assert house.probe("gold_order_backlog")
    log = house["expectation_log"]
    assert log.where("expectation = 'positive_qty'").count() == 2
    assert log.where("failed > 0").count() == 0
    tags = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {house.qualified('gold_order_backlog')}").collect()}
    assert tags["quality"] == "gold"


def test_failed_write_keeps_the_table(spark):
    house = Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}")
    house.write("kept", spark.range(3), "gold")
    with pytest.raises(Exception, match="broken"):
        house.write("kept", spark.range(5).selectExpr("IF(id = 4, raise_error('broken'), id) AS id"))
    assert house["kept"].count() == 3 and list(house) == ["kept"]
    house.write("kept", house["kept"].where("id > 0"))
    assert house["kept"].count() == 2 and list(house) == ["kept"]


def test_exact_csv_keeps_every_text(spark):
    texts = [None, "", " x ", "a\nb", "a\r\nb", 'say "hi"', "back\\slash", "\\N", "\\", "\\\\N", "tab\t,comma", "'", '""', "#"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    path = f"/tmp/tallyforge-run-{uuid.uuid4().hex}"
    write_csv(rows, path, exact=True)
    assert sorted(read_csv(spark, path, rows.schema, exact=True).collect()) == rows.orderBy("id").collect()


def test_readers_never_miss_a_replaced_table(spark):
    house = Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}")
    house.write("kept", spark.range(5).withColumn("part", F.col("id") % 2), "gold", "it's", ["part"])
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(house["kept"].count())
            except Exception as error:  # noqa: BLE001
                failed.append(str(error))

    reader = threading.Thread(target=read)
    reader.start()
    for size in (6, 7, 8):
        house.write("kept", spark.range(size).withColumn("part", F.col("id") % 3), "gold", "it's", ["part"])
    stop.set()
    reader.join()
    assert not failed and seen <= {5, 6, 7, 8}
    # Only the version that is shown and the one before it are left.
    assert house["kept"].count() == 8 and len(house._versions("kept")) == 2 and list(house) == ["kept"]
    tags = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {house.qualified('kept')}").collect()}
    assert tags["quality"] == "gold" and spark.catalog.getTable(house.qualified("kept")).description == "it's"


@pytest.mark.parametrize("step", ["_shown", "_show", "_drop"])
def test_a_write_that_dies_leaves_old_or_new_rows(spark, monkeypatch, step):
    house = Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}")
    for size in (1, 2):
        house.write("kept", spark.range(size))
    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            house.write("kept", spark.range(3))
    assert house["kept"].count() == (3 if step == "_drop" else 2)
    house.write("kept", spark.range(4).withColumnRenamed("id", "number"))
    assert house["kept"].columns == ["number"] and house["kept"].count() == 4
    assert len(house._versions("kept")) == 2


def test_a_plain_table_becomes_the_first_version(spark):
    house = Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}")
    spark.range(3).write.saveAsTable(house.qualified("kept"))
    house.write("kept", house["kept"].where("id > 0"))
    assert house["kept"].count() == 2 and list(house) == ["kept"]
