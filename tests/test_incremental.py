"""Refreshed tables against rebuilds from all of bronze, what a refresh reads and rewrites, and refreshes that die."""

import time
import uuid
from datetime import datetime
from pathlib import Path

import pytest

from __spark_entry__ import silver_incremental
from tallyforge.operators.silver import to_silver
from tallyforge.plans.incremental import SilverVersions
from tallyforge.session import SHUFFLE_CLEANUP, shared_root, stored
from tallyforge.sources.feeds import FEEDS
from tallyforge.sources.warehouse import Warehouse
from tallyforge.streaming.ingest import feed_deliveries

FX = FEEDS["fx_rates"]
HEADER = "rate_id,from_currency,to_currency,time_id,spot_rate,budget_rate,avg_rate"


@pytest.fixture
def place(spark):
    root = Path(f"/tmp/tallyforge-incremental-{uuid.uuid4().hex}")
    (root / "landing").mkdir(parents=True)
    house = Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}")
    deliveries = feed_deliveries(spark, FX, str(root / "bronze"))

    def land(name, *lines):
        (root / "landing" / name).write_text("\n".join([HEADER, *lines]) + "\n")
        deliveries.land_waiting(str(root / "landing"), FX.glob)

    return land, deliveries, SilverVersions(house, FX, buckets=8), house


def rate(number, spot):
    return f"{number},EUR,USD,20250101,{spot},1.0,1.0"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_refreshes_equal_rebuilds(place):
    land, deliveries, silver, house = place
    steps = [
        [rate(f"FX{k}", 1 + k / 10) for k in range(40)],
        [rate("FX1", 9.5), rate("FX2", "oops"), rate("FX50", 2.5), "FX3,EUR"],
        [rate("", 1.0), rate("FX1", 7.5), rate("FX51", 3.5)],
        ["FX4"],
    ]
    for number, lines in enumerate(steps):
        land(f"fx_rates_{number}.csv", *lines)
        counts = silver.refresh(deliveries)
        assert rows(house[FX.silver_table]) == rows(to_silver(deliveries.rows(), FX).select(house[FX.silver_table].columns))
    assert counts["rescued_lines"] == 1
    land("fx_rates_1.csv", rate("FX2", 4.25))
    silver.refresh(deliveries)
    found = {r.rate_id: float(r.spot_rate) for r in house[FX.silver_table].collect()}
    assert found["FX1"] == 7.5 and found["FX2"] == 4.25 and found["FX3"] == 1.3 and len(found) == 42
    assert silver.refresh(deliveries) == {"rows": 0}


def test_a_refresh_reads_new_batches_and_rewrites_touched_buckets(place):
    land, deliveries, silver, house = place
    land("fx_rates_1.csv", *[rate(f"FX{k}", 1.0) for k in range(60)])
    silver.refresh(deliveries)
    first = silver.current()
    assert set(first.places.values()) == {1} and len(first.places) == 8
    land("fx_rates_2.csv", rate("FX7", 2.0))
    assert all("_batch=2" in path for path in deliveries.rows(after=first.batch).inputFiles())
    silver.refresh(deliveries)
    second = silver.current()
    changed = [b for b, v in second.places.items() if v == 2]
    assert len(changed) == 1 and second.batch == 2
    kept = [path for path in house[FX.silver_table].inputFiles() if "/v=1/" in path]
    assert kept and not any(f"_bucket={changed[0]}/" in path for path in kept if "/v=2/" in path)
    assert house[FX.silver_table].count() == 60


@pytest.mark.parametrize("step", ["_filled", "_commit", "_show", "_clean"])
def test_a_refresh_that_dies_leaves_old_or_new_rows(place, monkeypatch, step):
    land, deliveries, silver, house = place
    land("fx_rates_1.csv", rate("FX1", 1.0), rate("FX2", 2.0))
    silver.refresh(deliveries)
    old = rows(house[FX.silver_table])
    land("fx_rates_2.csv", rate("FX1", 5.0))
    with monkeypatch.context() as broken:
        broken.setattr(SilverVersions, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            silver.refresh(deliveries)
    seen = rows(house[FX.silver_table])
    silver.refresh(deliveries)
    new = rows(house[FX.silver_table])
    assert seen == (new if step == "_clean" else old) and new != old
    assert new == rows(to_silver(deliveries.rows(), FX).select(house[FX.silver_table].columns))


def test_rounds_give_the_rows_and_counts_of_one_refresh(place, spark):
    land, deliveries, silver, house = place
    small = SilverVersions(Warehouse(spark, f"plan_{uuid.uuid4().hex[:8]}"), FX, buckets=8, round_bytes=1)
    steps = [
        [rate(f"FX{k}", 1 + k / 10) for k in range(40)],
        [*[rate(f"FX{k}", -k) for k in range(20, 60)], rate("", 1.0), rate("FX2", "oops"), "FX3,EUR"],
        [rate("FX5", 3.0)],
        ["FX4"],
    ]
    for number, lines in enumerate(steps):
        land(f"fx_rates_{number}.csv", *lines)
        assert small.refresh(deliveries) == silver.refresh(deliveries)
        assert rows(small.warehouse[FX.silver_table]) == rows(house[FX.silver_table])
        assert set(small.current().places) == set(silver.current().places)
    assert len(small._rounds(list(range(8)), small.current(), deliveries)) == 8


def test_a_refresh_leaves_no_rows_of_its_own(place, spark):
    land, deliveries, silver, _ = place

    def left():
        return {p.name for p in Path(shared_root(spark)).glob("*-fresh-*")}

    before = left()
    land("fx_rates_1.csv", rate("FX1", 1.0))
    silver.refresh(deliveries)
    land("fx_rates_2.csv", rate("FX1", 2.0))
    silver.refresh(deliveries)
    assert left() == before


def test_stored_rows_go_and_so_do_the_shuffle_files_of_their_jobs(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = blocks.getAllFiles()
        names = {files.apply(k).getName() for k in range(files.size())}
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffles()
    dealt = spark.range(1000).repartition(4, "id")
    with stored([dealt.where("id < 400"), dealt.where("id >= 400")], "test-stored") as found:
        (path,) = {file.rsplit("/", 1)[0].removeprefix("file://") for file in found.inputFiles()}
        until = time.time() + 30
        while (left := shuffles() - before) and time.time() < until:
            time.sleep(0.5)
        assert not left
        assert sorted(r.id for r in found.collect()) == list(range(1000))
    assert not Path(path).exists() and spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_landed_files_go_and_changed_ones_stay(place, spark):
    land, deliveries, silver, house = place
    landing = Path(deliveries.out).parent.parent / "landing"
    (landing / "other.csv").write_text("kept")
    land("fx_rates_0.csv", rate("FX0", 1.0))
    (landing / "fx_rates_1.csv").write_text("\n".join([HEADER, rate("FX1", 1.0)]) + "\n")
    # The first file landed in a run that didn't delete it, and it has changed since.
    (landing / "fx_rates_0.csv").write_text("\n".join([HEADER, rate("FX0", 2.0), rate("FX9", 1.0)]) + "\n")
    assert deliveries.land_waiting(str(landing), FX.glob, clean=True) == 2
    assert [p.name for p in landing.iterdir() if p.suffix == ".csv"] == ["other.csv"]
    assert deliveries.land_waiting(str(landing), FX.glob, clean=True) == 0
    silver.refresh(deliveries)
    assert {r.rate_id: float(r.spot_rate) for r in house[FX.silver_table].collect()} == {"FX0": 2.0, "FX1": 1.0, "FX9": 1.0}


def test_a_file_that_changes_while_others_are_deleted_stays(place, monkeypatch):
    land, deliveries, _, _ = place
    landing = Path(deliveries.out).parent.parent / "landing"
    land("fx_rates_0.csv", rate("FX0", 1.0))
    listed = type(deliveries)._listed

    def changed_after_listing(self, folder, pattern):
        found = listed(self, folder, pattern).localCheckpoint()
        (landing / "fx_rates_0.csv").write_text("\n".join([HEADER, rate("FX0", 1.0), rate("FX1", 1.0)]) + "\n")
        return found

    with monkeypatch.context() as late:
        late.setattr(type(deliveries), "_listed", changed_after_listing)
        deliveries._clean(str(landing), FX.glob)
    assert (landing / "fx_rates_0.csv").exists()
    assert deliveries.land_waiting(str(landing), FX.glob, clean=True) == 1
    assert not (landing / "fx_rates_0.csv").exists()


def test_the_query_leaves_no_deliveries_and_no_text(spark, make, tmp_path):
    lines = [(k, 7, k % 4, 3.0, 10.0 + k, 0.05, datetime(2000, 1, 2)) for k in range(30)]
    kinds = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    make(lines, f"{kinds}, l_discount double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = make([(k, 5, "O", datetime(2000, 1, 1)) for k in range(25)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    root = Path(shared_root(spark))
    before = set(root.iterdir())
    found = silver_incremental(spark, str(tmp_path)).select("order_id", "unit_price", "net_amount_usd").collect()
    assert len(found) == 25 and len({r.order_id for r in found}) == 25 and min(r.net_amount_usd for r in found) > 1
    (made,) = set(root.iterdir()) - before
    assert made.name.startswith("incremental-") and not list(made.glob("landing/*.csv"))


def test_nothing_landed_gives_an_empty_table(place, spark):
    _, deliveries, silver, house = place
    silver.refresh(deliveries)
    assert house[FX.silver_table].count() == 0
    assert house[FX.silver_table].columns == [c for c, _ in FX.columns]
