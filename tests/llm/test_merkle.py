"""The manifest against a plain tree over whole lists, at block heights that need several rounds."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import merkle
from tallyforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = (doc_id, source, lang, n_chars, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root, and for each leaf the siblings of each level with its place."""
    rows, proofs, where = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(rows) > 1:
        for proof, at in zip(proofs, where, strict=True):
            run = rows[at // 3 * 3 : at // 3 * 3 + 3]
            proof.append((at % 3, run[: at % 3] + run[at % 3 + 1 :]))
        rows = [h(*rows[k : k + 3]) for k in range(0, len(rows), 3)]
        where = [at // 3 for at in where]
    return rows[0], proofs


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row, leaf_of(*row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda e: (e[0][0] is not None, e[0][0] or 0, e[1]))
        trees[name] = tree([leaf for _, leaf in groups[name]])
    root, upper = tree([trees[name][0] for name in names])
    out = []
    for name, above in zip(names, upper, strict=True):
        for (row, leaf), below in zip(groups[name], trees[name][1], strict=True):
            doc_id, source, lang, n_chars, text = row
            broken = text
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                broken = text.replace("\n", "")
            folded = leaf_of(doc_id, source, lang, n_chars, broken)
            for at, others in below + above:
                folded = h(*others[:at], folded, *others[at:])
            proof = h(*(d for _, others in below + above for d in others))
            out.append((doc_id, leaf, trees[name][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_a_plain_tree(spark, make, levels, monkeypatch):
    rng = random.Random(levels)
    rows = [(k, rng.choice(["a", "a", "a", "b", "é", "Z", None, ""]), "en", k, f"text\n{k % 50}") for k in range(140)]
    rows += [(None, None, None, None, None), (None, "a", None, 3, ""), (5, "a", "x", 1, "twice"), (5, "a", "x", 1, "twice")]
    rows += [(900, "lone", "en", 1, "x\ny"), (2, "b", "en", None, "long " * 5000)]
    rng.shuffle(rows)
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda docs, changed: whole(docs, changed=changed, levels=levels))
    docs = make(rows, SCHEMA).withColumns({"g": F.lit("x"), "index": F.lit(1), "digest": F.lit("d")}).repartition(7)
    got = sorted((tuple(r) for r in merkle.verified(docs).collect()), key=str)
    assert got == brute(rows)


def test_proofs_fold_and_empty_tables(make):
    rows = [(k, "s", "en", 1, str(k)) for k in range(30)]
    for r in merkle.manifest(make(rows, SCHEMA), levels=2).collect():
        assert merkle.fold(bytes(r.leaf), bytes(r.proof)) == bytes(r.root) == bytes(r.subroot)
        assert len(list(merkle.siblings(bytes(r.proof)))) == merkle.height(30)
    assert merkle.verified(make([], SCHEMA)).count() == 0
    one = merkle.verified(make([(1, None, None, None, None)], SCHEMA)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.proof_sha256 == h()


def test_other_columns_and_names(make):
    docs = make([(1, "a", "x"), (2, "b", "y")], "k int, part string, body string")
    got = merkle.manifest(docs, id_column="k", group_column="part", fields=("k", "body")).orderBy("doc_id").collect()
    assert [bytes(r.leaf).hex() for r in got] == [h("1:11:x"), h("1:21:y")]


def test_query_equals_a_plain_tree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, SMALL).collect()), key=str)
    assert got == brute([tuple(r) for r in docs.collect()])
