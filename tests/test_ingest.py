import os
import time
import uuid
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from tallyforge.operators.silver import to_silver
from tallyforge.sources.feeds import FEEDS
from tallyforge.sources.files import read_csv, write_csv
from tallyforge.streaming.deliveries import Deliveries
from tallyforge.streaming.ingest import feed_deliveries, ingest, ingest_feed

FEED = FEEDS["currency_master"]
FX = FEEDS["fx_rates"]


@pytest.fixture
def root():
    path = Path(f"/tmp/tallyforge-ingest-{uuid.uuid4().hex}")
    (path / "landing").mkdir(parents=True)
    return path


def land(root, name, lines, header="rate_id,from_currency,to_currency,time_id,spot_rate,budget_rate,avg_rate"):
    # Written beside the folder and moved in, so the stream never sees half a file.
    part = root / f"{name}.part"
    part.write_text("\n".join([header, *lines]) + "\n")
    part.rename(root / "landing" / name)


def run(spark, root, **options):
    return ingest_feed(spark, FX, str(root / "landing"), str(root / "bronze"), **options)


def rate(number, spot):
    return f"FX{number},EUR,USD,20250101,{spot},1.0,1.0"


def test_each_file_once_over_three_runs(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1), rate(2, 1.2)])
    assert run(spark, root).count() == 2
    land(root, "fx_rates_2.csv", [rate(3, 1.3)])
    assert run(spark, root).count() == 3
    assert run(spark, root).count() == 3


def test_metadata_columns(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    row = run(spark, root).first()
    assert row._source_file.endswith("fx_rates_1.csv") and row._ingested_at is not None
    assert row.spot_rate == "1.1"


def test_other_files_are_left_alone(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    land(root, "notes.csv", ["x"], header="y")
    assert run(spark, root).count() == 1


def test_many_batches_equal_one(spark, root):
    for n in range(4):
        land(root, f"fx_rates_{n}.csv", [rate(n, 1 + n / 10), rate(9, n)])
    stepwise = to_silver(run(spark, root, max_files=1), FX)
    whole = read_csv(spark, str(root / "landing"), FX.raw_schema)
    assert {r.rate_id for r in stepwise.collect()} == {r.rate_id for r in whole.collect()}
    assert stepwise.count() == 5


def test_later_correction_wins(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    run(spark, root)
    land(root, "fx_rates_2.csv", [rate(1, 1.5)])
    assert float(to_silver(run(spark, root), FX).first().spot_rate) == 1.5


def test_wrong_header_stops_a_plain_stream(spark, root):
    land(root, "fx_rates_1.csv", ["1,2,3,4,5,6,7"], header="a,b,c,d,e,f,g")
    with pytest.raises(StreamingQueryException):
        ingest(spark, f"{root}/landing/fx*.csv", FX.raw_schema, f"{root}/out", f"{root}/checkpoint")


def test_widened_narrowed_and_reordered_files(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    assert run(spark, root).count() == 1
    land(root, "fx_rates_2.csv", ["EUR,USD,FX2,20250101,1.2,1.0,desk 7,1.0"],
         "from_currency,to_currency,rate_id,time_id,spot_rate,budget_rate,desk,avg_rate")
    land(root, "fx_rates_3.csv", ["FX3,1.3", "FX4,1.4,too many"], "\ufeffrate_id,spot_rate")
    land(root, "fx_rates_4.csv", ["1,2"], "a,b")
    land(root, "fx_rates_5.csv", [])
    land(root, "fx_rates_é 100%6.csv", [rate(6, 1.6)])
    # A file without a byte is no delivery.
    (root / "landing" / "fx_rates_7.csv").write_text("")
    rows = {r.rate_id: r for r in run(spark, root).collect()}
    assert rows["FX1"]._extra_columns is None and rows["FX1"].spot_rate == "1.1"
    assert (rows["FX2"].from_currency, rows["FX2"].avg_rate, rows["FX2"]._extra_columns) == ("EUR", "1.0", {"desk": "desk 7"})
    assert rows["FX3"].avg_rate is None and rows["FX3"]._rescued_data is None
    assert rows["FX4"]._rescued_data == "FX4,1.4,too many" and rows[None]._extra_columns == {"a": "1", "b": "2"}
    ledger = {r.path[-5]: r for r in feed_deliveries(spark, FX, str(root / "bronze")).ledger().collect()}
    assert ledger["2"].unknown == ["desk"] and ledger["2"].missing == [] and ledger["3"].rows == 2
    assert len(ledger["4"].missing) == 7 and ledger["5"].rows == 0 and len(ledger) == 6 and ledger["6"].rows == 1
    silver = to_silver(run(spark, root), FX)
    assert {r.rate_id for r in silver.collect()} == {"FX1", "FX2", "FX3", "FX6"} and "_extra_columns" not in silver.columns


def test_new_content_under_an_old_name(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1), rate(2, 1.2)])
    run(spark, root)
    land(root, "fx_rates_1.csv", [rate(1, 1.75)])
    assert run(spark, root).count() == 3
    assert {r.rate_id: float(r.spot_rate) for r in to_silver(run(spark, root), FX).collect()} == {"FX1": 1.75, "FX2": 1.2}
    feed = feed_deliveries(spark, FX, str(root / "bronze"))
    assert feed.ledger().count() == 2 and feed.rows(after=1).count() == 1


def test_crash_between_rows_and_ledger_repeats_nothing(spark, root, monkeypatch):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    run(spark, root)
    land(root, "fx_rates_2.csv", [rate(2, 1.2), rate(3, 1.3)])
    commit = Deliveries._commit
    monkeypatch.setattr(Deliveries, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run(spark, root)
    feed = feed_deliveries(spark, FX, str(root / "bronze"))
    assert (root / "bronze" / FX.bronze_table / "_batch=2").exists() and feed.rows().count() == 1
    monkeypatch.setattr(Deliveries, "_commit", commit)
    land(root, "fx_rates_3.csv", [rate(4, 1.4)])
    assert sorted(r.rate_id for r in run(spark, root).collect()) == ["FX1", "FX2", "FX3", "FX4"]


def test_stream_of_deliveries(spark, root):
    feed = feed_deliveries(spark, FX, str(root / "bronze"))
    for number in (1, 2):
        land(root, f"fx_rates_{number}.csv", [rate(number, 1.0 + number)])
        feed.watch(str(root / "landing"), FX.glob, str(root / "checkpoint")).awaitTermination()
        assert feed.rows().count() == number
    land(root, "fx_rates_2.csv", [rate(2, 9.5)])
    assert feed.land_waiting(str(root / "landing"), FX.glob) == 1 and feed.last_batch() == 3


def test_ragged_lines_are_kept_with_their_text(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1), rate(2, 1.2) + ",extra", "FX3,EUR"])
    rows = {r.rate_id: r for r in run(spark, root).collect()}
    assert rows["FX1"]._rescued_data is None
    assert rows["FX2"]._rescued_data.endswith(",extra") and rows["FX2"].avg_rate == "1.0"
    assert rows["FX3"]._rescued_data == "FX3,EUR" and rows["FX3"].spot_rate is None
    clean = to_silver(run(spark, root), FX)
    assert [r.rate_id for r in clean.collect()] == ["FX1"] and "_rescued_data" not in clean.columns


def test_ragged_line_does_not_replace_a_record(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    run(spark, root)
    land(root, "fx_rates_2.csv", ["FX1,EUR"])
    assert float(to_silver(run(spark, root), FX).first().spot_rate) == 1.1


def test_old_file_is_not_skipped(spark, root):
    land(root, "fx_rates_1.csv", [rate(1, 1.1)])
    run(spark, root)
    land(root, "fx_rates_0.csv", [rate(2, 1.2)])
    month_ago = time.time() - 30 * 86400
    os.utime(next(root.rglob("fx_rates_0.csv")), (month_ago, month_ago))
    assert to_silver(run(spark, root), FX).count() == 2


def test_csv_round_trip_keeps_blanks_and_line_breaks(spark, root, make):
    rows = [(" x ", "a\nb"), ("\ty", 'q"\n"')]
    write_csv(make(rows, "currency_code string, currency_name string"), str(root / "out"))
    back = read_csv(spark, str(root / "out"), FEED.raw_schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_round_trip_keeps_awkward_text(spark, root, make):
    awkward = [("a,b", 'say "hi"'), ("it's", None), ("ü\\n", "x")]
    df = make(awkward, "currency_code string, currency_name string")
    write_csv(df, str(root / "out"))
    back = read_csv(spark, str(root / "out"), FEED.raw_schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(awkward, key=str)
