"""Pieces, spans and texts against the library, with the model's own map and with a compiled one."""

import hashlib
import random
import struct

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallyforge.llm import aligned_pieces as ap
from tallyforge.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(ap.MODEL)
TEXTS = [
    "", " ", "  a  b ", "\0", "a\0b", "▁▁ ▁a▁", "x" * 5000 + " y" * 30, "🙂 é\r\n\t  z", "ab" * 3000 + "   " * 99,
    "Ünïcode ﬁ １２ ㎞ x", "é ̈́ ｶﾞ", "𝒳日本語", "<s> </s> <unk> <0x41>", "　 leading", "trail 　",
]


def varint(n):
    out = bytearray()
    while True:
        out.append(n & 0x7F | (0x80 if n > 0x7F else 0))
        n >>= 7
        if not n:
            return bytes(out)


def with_map(rule, *flags):
    """The model with the library's compiled map ``rule`` and normaliser flags (field, value) in place of its own."""
    compiled = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = next(v for k, v in ap._fields(compiled) if k == 3)
    spec += b"".join(varint(k << 3) + varint(v) for k, v in flags)
    with open(PATH, "rb") as file:
        model = file.read()
    out = b""
    for k, v in ap._fields(model):
        if k != 3:
            out += varint(k << 3 | 2) + varint(len(v)) + v
    return out + varint(3 << 3 | 2) + varint(len(spec)) + spec


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["text"])
    rng = random.Random(5)
    letters = "ab e\t\n.▁ﬁ㎞é\u0301ｶﾞ　🙂x"
    made = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(300)]
    return TEXTS + made + table["text"].to_pylist()[:60]


@pytest.mark.parametrize(
    "rule, flags",
    [(None, ()), ("nmt_nfkc", ()), ("nfkc_cf", ((4, 0),)), ("nmt_nfkc", ((3, 0), (4, 0))), ("nmt_nfkc", ((3, 0),))],
)
def test_ids_spans_and_texts_equal_the_library(texts, rule, flags):
    if rule is None:
        with open(PATH, "rb") as file:
            model = file.read()
    else:
        model = with_map(rule, *flags)
    own, library = ap.PieceBpe(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    assert bool(own.map.rules) == (rule is not None)
    for text in texts:
        got, want = own.encode(text, False, False), library.EncodeAsProto(text).pieces
        assert list(zip(*(a.tolist() for a in got), strict=True)) == [(p.id, p.begin, p.end) for p in want], text[:80]
        ids = own.encode(text).ids.tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True)
        assert own.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_the_library_does():
    own, library = ap.codec(ap.MODEL), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(9)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(259), rng.randrange(32000), 28705]) for _ in range(rng.randrange(12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_slices_of_a_long_text_change_nothing(monkeypatch, texts):
    own = ap.codec(ap.MODEL)
    long = " ".join(texts)
    whole = own.encode(long)
    monkeypatch.setattr(ap, "SLICE", 50)
    parts = own.encode(long)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert (whole.begins[1:] >= whole.ends[:-1]).all() and whole.ends[-1] == len(long.encode())


def test_heap_and_loop_merge_alike(texts):
    own = ap.codec(ap.MODEL)
    for text in texts[:200]:
        for segment in own.segment.findall(own.normalise(text)[0]):
            if len(segment) <= ap.LONGEST_KEPT:
                assert own._parts(segment) == own._parts_of_long(list(segment))


def test_columns_and_odd_rows(make):
    rows = [(1, None, 7), (2, "", 7), (3, "one two", 8), (3, "one two", 8), (None, "日 x", 9)]
    df = make(rows, "doc_id long, text string, piece_ids int").withColumn("c0", F.lit("x"))
    out = ap.decode(ap.encode(df))
    assert out.columns == ["doc_id", "text", "c0", "piece_ids", "piece_begins", "piece_ends", "decoded"]
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert out.count() == 5 and got[1, None].piece_ids == [1, 2] and got[1, None].decoded == ""
    assert got[3, "one two"].decoded == "one two" and got[3, "one two"].piece_ends == [0, 3, 7, 7]
    assert ap.decode(ap.encode(df.where("doc_id > 9"))).count() == 0
    assert ap.decode(df.select(F.lit(None).cast("array<int>").alias("piece_ids"))).first().decoded == ""
    assert ap.encoded_digests(df).count() == 5 and ap.encoded_digests(df.where("doc_id > 9")).count() == 0


def test_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op11_aligned_pieces"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode(docs[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.covered_bytes == len((docs[r.doc_id] or "").encode())
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
