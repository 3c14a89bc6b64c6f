"""Repairs against a plain program over whole edit strings, with blocks that short conversations already exceed."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import conversations as cv
from tallyforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
LAST = re.compile(r"[.!?][\x20\x09-\x0d]*\Z")


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        code = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        kept.extend([(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1))
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0d]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if LAST.search(text) else "truncated")
        seen.add((role, text))
    return faults


def best_repair(rows, faults):
    """Least (cost, edits) with the lines they give, from the best whole strings for each end of the repaired part."""

    def offer(states, made, cost, audit, lines):
        end = made if made in ("", "s") else made[-1]
        if re.fullmatch("s?(ua)*u?", made) and (end not in states or (cost, audit) < states[end][:2]):
            states[end] = (cost, audit, lines, made)

    def inserted(states):
        for _ in range(3):
            for cost, audit, lines, made in list(states.values()):
                for role in ("user", "assistant"):
                    offer(states, made + role[0], cost + 2, audit + "I", [*lines, f"{role}:"])
        return states

    states = {"": (0, "", [], "")}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after, extra = {}, fault == "truncated"
        # Inserting may not replace the way on without inserts, so every number of inserts is tried by itself.
        options = [(c, a, o, m) for c, a, o, m in states.values()]
        for cost, audit, lines, made in list(options):
            for _ in range(3):
                role_next = "assistant" if made[-1:] == "u" else "user"
                made, cost, audit, lines = made + role_next[0], cost + 2, audit + "I", [*lines, f"{role_next}:"]
                options.append((cost, audit, lines, made))
        for cost, audit, lines, made in options:
            offer(after, made, cost + 3, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                offer(after, made + (role[:1] or "?"), cost + extra, audit + "K", [*lines, f"{role}:{text}"])
                for new in ("user", "assistant"):
                    offer(after, made + new[0], cost + 2 + extra, audit + "R", [*lines, f"{new}:{text}"])
        states = after
    ends = inserted(dict(states))
    return min((v for end, v in ends.items() if end in ("", "a")), key=lambda v: v[:2])


def brute(table):
    out = []
    for conv, rows in damaged(table).items():
        faults = faults_of(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        roles = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit, lines, _ = best_repair(rows, faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=str)


def rows_of(found):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=str)


@pytest.fixture(scope="module")
def table():
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "s", "ua"]
    texts = ["Yes.", "No!  \n", "what?", "cut off", "", " \t", None, "é。", "a\x0b", ".\x85", "Same.", "x" * 300]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.choice([0, 1, 2, 5, 9])):
            turn = rng.choice([turn, turn, turn, turn + 3, None, turn - 2])
            rows.append((conv, turn, rng.choice(roles), f"{rng.choice(texts) or ''}" if rng.random() < 0.9 else None))
    rows += [(7000, t, "assistant" if t % 2 else "user", f"Turn {t % 400}.") for t in range(1200)]
    rows += [(8000 + k, 0, "user", "one") for k in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_rows", [1, 3, 64, cv.BLOCK_ROWS])
def test_repair_equals_whole_strings(make, table, block_rows):
    df = make(table, SCHEMA).withColumns({"key": F.lit(1), "gone": F.lit("x"), "kind": F.lit(2), "same": F.lit(3)})
    assert rows_of(cv.repair(cv.damage(df.repartition(5)), "gone", block_rows)) == brute(table)


def test_edges(make):
    assert cv.repaired_damage(make([], SCHEMA)).count() == 0
    got = cv.repair(make([(1, None, None, None), (2, 5, "system", "a."), (2, 9, "user", "b.")], SCHEMA).withColumn("gone", F.lit("x"))).collect()
    found = {r.conv_id: r for r in got}
    assert (found[1].blank, found[1].cost, found[1].audit, found[1].gaps) == (1, 3, "D", 0)
    assert found[1].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert (found[2].audit, found[2].gaps, found[2].cost) == ("KKI", 3, 2)
    assert found[2].repaired_sha256 == hashlib.sha256(b"system:a.\nuser:b.\nassistant:").hexdigest()


def test_query_equals_whole_strings(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(QUERIES["op13_conversation_repair"](spark, SMALL)) == brute([tuple(r) for r in rows])
