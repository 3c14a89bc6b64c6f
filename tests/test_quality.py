from tallyforge.operators.quality import (
    Expectation,
    expectation_report,
    keep_valid,
    observe_expectations,
    orphan_keys,
    orphan_report,
)

RULES = [
    Expectation("has_id", "id IS NOT NULL", drops=True),
    Expectation("positive", "qty > 0"),
]


def data(make):
    return make([(1, 5), (2, 0), (3, None), (None, 7)], "id int, qty int")


def test_drop_keeps_only_true(make):
    kept = keep_valid(data(make), RULES)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3]


def test_null_predicate_is_a_failure(make):
    report = {r.expectation: r for r in expectation_report(data(make), RULES, "t").collect()}
    assert (report["has_id"].passed, report["has_id"].failed) == (3, 1)
    assert (report["positive"].passed, report["positive"].failed) == (2, 2)
    assert report["has_id"].action == "drop" and report["positive"].action == "warn"


def test_drops_and_kept_add_up(make):
    kept, seen = observe_expectations(data(make), RULES, "obs")
    count = kept.count()
    assert seen.get["rows"] == 4
    assert seen.get["has_id"] + count == seen.get["rows"]
    assert seen.get["positive"] == 2


def test_orphans(make):
    fact = make([("a",), ("a",), ("b",), ("c",), (None,)], "fk string")
    dim = make([("b",)], "id string")
    found = {r.fk_value: r.fact_rows for r in orphan_keys(fact, dim, "fk", "id").collect()}
    assert found == {"a": 2, "c": 1}
    both = orphan_report({"x": (fact, dim, "fk", "id"), "y": (dim, dim, "id", "id")})
    assert {tuple(r) for r in both.collect()} == {("x", 2, 3), ("y", 0, 0)}


def test_orphans_in_one_pass(spark, make, tmp_path):
    fact = [("a", "1", 1), ("a", "2", 1), (None, "x", 2), ("c", None, 2), ("a", "01", 9), (None, "0", None), (None, "", 0)]
    make(fact, "k string, n string, m int").write.parquet(str(tmp_path / "fact"))
    make([("a", 1, 1), ("b", 2, 2), (None, None, None)], "name string, number int, other long").write.parquet(str(tmp_path / "dim"))
    rows, dim = spark.read.parquet(str(tmp_path / "fact")), spark.read.parquet(str(tmp_path / "dim"))
    checks = {
        "name": (rows, dim, "k", "name"), "number": (rows, dim, "n", "number"), "other": (rows, dim, "m", "other"),
        "none": (rows.limit(0), dim, "k", "name"), "itself": (dim, dim, "name", "name"),
    }
    report = orphan_report(checks)
    assert {r.check_name: (r.orphan_keys, r.orphan_rows) for r in report.collect()} == {
        "name": (1, 1), "number": (3, 3), "other": (2, 2), "none": (0, 0), "itself": (0, 0),
    }
    three = orphan_report({name: checks[name] for name in ("name", "number", "other")})
    plan = three._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4 and plan.count("ReadSchema: struct<k:string,n:string,m:int>") == 1
    assert plan.count("LeftAnti") == 1
