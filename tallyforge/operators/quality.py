"""Row expectations: count violations, drop failing rows, report, check keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate; a row fails when it is false or NULL."""

    name: str
    predicate: str
    drops: bool = False

    def failed(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


def keep_valid(df: DataFrame, rules: Iterable[Expectation]) -> DataFrame:
    """Remove the rows that fail a dropping rule."""
    for rule in rules:
        if rule.drops:
            df = df.where(F.expr(rule.predicate))
    return df


def observe_expectations(
    df: DataFrame, rules: Sequence[Expectation], label: str
) -> tuple[DataFrame, Observation]:
    """Count failures while the rows pass by, then drop what must go.

    The counts ride on the job that writes the table, so there is no second
    scan. They are ready in ``Observation.get`` after that job.
    """
    seen = Observation(label)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(rule.failed()).alias(rule.name) for rule in rules]
    return keep_valid(df.observe(seen, *metrics), rules), seen


def expectation_report(df: DataFrame, rules: Sequence[Expectation], table: str) -> DataFrame:
    """One row per rule with passed and failed row counts; one aggregate pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(rule.failed()).alias(f"f{i}") for i, rule in enumerate(rules)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("expectation"),
                F.lit("drop" if rule.drops else "warn").alias("action"),
                (F.col("rows") - F.col(f"f{i}")).alias("passed"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(entries))


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Foreign key values without a dimension row, with the rows they affect.

    The fact is reduced to one row per key before the join, so a key that holds
    a large part of the fact costs one row per map task in the shuffle.
    """
    used = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("fk_value"))
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    known = dim.select(F.col(dim_key).alias("fk_value"))
    return used.join(known, "fk_value", "left_anti")


_KEY = ["fk_number", "fk_text"]


def orphan_report(
    checks: Mapping[str, tuple[DataFrame, DataFrame, str, str]],
) -> DataFrame:
    """Orphan key and row totals per named check, each a fact, a dimension and the key column of either.

    Checks that hand in the same frame share its scan: its key columns are counted as grouping sets in one pass, and the
    keys of a dimension are read once for all checks against the column. One anti-join serves the whole report. Keys are
    compared as whole numbers where both sides are, else as text of the dimension's type; one that does not fit it is an
    orphan.
    """
    dims: dict[tuple[int, str, bool], tuple[int, DataFrame]] = {}
    facts: dict[int, tuple[DataFrame, list[tuple[int, Column, bool]]]] = {}
    dim_of = []
    for check, (fact, dim, fact_key, dim_key) in enumerate(checks.values()):
        kind = dim.schema[dim_key].dataType
        whole = all(isinstance(t, T.IntegralType) for t in (kind, fact.schema[fact_key].dataType))
        number, _ = dims.setdefault((id(dim), dim_key, whole), (len(dims), dim))
        dim_of.append(F.lit(number))
        key = F.col(fact_key)
        value = key.cast("long") if whole else F.coalesce(key.try_cast(kind).cast("string"), key.cast("string"))
        facts.setdefault(id(fact), (fact, []))[1].append((check, value, whole))
    used = None
    for fact, entries in facts.values():
        names = [f"k{check}" for check, _, _ in entries]
        keys = fact.select(*[value.alias(n) for n, (_, value, _) in zip(names, entries, strict=True)])
        # Bit of a column in the grouping id: set where the column is not part of the set.
        every = (1 << len(names)) - 1
        number_of = [F.lit(x) for k, (check, _, _) in enumerate(entries) for x in (every - (1 << (len(names) - 1 - k)), check)]
        counted = keys.groupingSets([[n] for n in names], *names).agg(
            F.grouping_id().cast("int").alias("gid"), F.count(F.lit(1)).alias("fact_rows")
        )
        numbers = [F.col(n) for n, (_, _, whole) in zip(names, entries, strict=True) if whole]
        texts = [F.col(n) for n, (_, _, whole) in zip(names, entries, strict=True) if not whole]
        counted = counted.where(F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()).select(
            F.create_map(*number_of)[F.col("gid")].alias("check"),
            F.coalesce(*numbers, F.lit(0).cast("long")).alias("fk_number"),
            F.coalesce(*texts, F.lit("")).alias("fk_text"),
            "fact_rows",
        )
        used = counted if used is None else used.unionByName(counted)
    known = None
    for (_, dim_key, whole), (number, dim) in dims.items():
        key = F.col(dim_key)
        keys = dim.where(key.isNotNull()).select(
            F.lit(number).alias("dim"),
            (key if whole else F.lit(0)).cast("long").alias("fk_number"),
            (F.lit("") if whole else key.cast("string")).alias("fk_text"),
        )
        known = keys if known is None else known.unionByName(keys)
    found = (
        used.withColumn("dim", F.element_at(F.array(*dim_of), F.col("check") + 1))
        .join(known, ["dim", *_KEY], "left_anti")
        .groupBy("check")
        .agg(F.count(F.lit(1)).alias("orphan_keys"), F.sum("fact_rows").alias("orphan_rows"))
    )
    names = used.sparkSession.createDataFrame(list(enumerate(checks)), "check int, check_name string")
    nothing = F.lit(0).cast("long")
    return names.join(found, "check", "left").select(
        "check_name", *[F.coalesce(c, nothing).alias(c) for c in ("orphan_keys", "orphan_rows")]
    )
