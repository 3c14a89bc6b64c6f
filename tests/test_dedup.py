import random

from tallyforge.operators.dedup import dedup_latest

SCHEMA = "k string, v string, at int, file string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_newest_wins(make):
    df = make([("a", "old", 1, "f"), ("a", "new", 2, "f"), ("b", "only", 1, "f")], SCHEMA)
    assert rows(dedup_latest(df, ["k"], ["at"])) == [("a", "new", 2, "f"), ("b", "only", 1, "f")]


def test_ties_use_every_remaining_column(make, spark):
    data = [("a", v, 1, f) for v in "pqr" for f in "xyz"]
    expected = [("a", "r", 1, "z")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = make(data, SCHEMA).repartition(4)
        assert rows(dedup_latest(df, ["k"], ["at"])) == expected
        by_file = dedup_latest(df, ["k"], ["at", "file"])
        assert rows(by_file) == expected


def test_missing_stamp_is_oldest_and_null_key_is_one_group(make):
    df = make([("a", "x", None, "f"), ("a", "y", 1, "f"), (None, "p", 1, "f"), (None, "q", 2, "f")], SCHEMA)
    assert rows(dedup_latest(df, ["k"], ["at"])) == [("a", "y", 1, "f"), (None, "q", 2, "f")]


def test_idempotent(make):
    df = make([(str(i % 5), str(i), i % 3, "f") for i in range(60)], SCHEMA)
    once = dedup_latest(df, ["k"], ["at"])
    assert rows(dedup_latest(once, ["k"], ["at"])) == rows(once)
    assert once.count() == 5


def test_hot_key_is_cut_down_before_the_shuffle(make):
    df = make([("hot", "v", i, "f") for i in range(50)], SCHEMA)
    plan = dedup_latest(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below_shuffle
