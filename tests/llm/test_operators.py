"""Operators against brute force, exact round trips or planted cases, and the cases that any table may hold."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import (
    byte_gru,
    class_lm,
    corpus,
    jaccard_join,
    licences,
    packing,
    prefix_bpe,
    sharding,
    templates,
    toxicity,
)
from tallyforge.llm.components import connected_components
from tallyforge.llm.digest_index import deduplicate, new_index
from tallyforge.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Null id, null and empty text, only blanks, repeats, few words, a very long text; a column with a clashing name.
ODD = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n ", "en"), (4, "one two", "en"), (4, "one two", "en"), (5, "one two", "de"),
    (None, "one two three four five six", "fr"), (6, "One two THREE four five six", None), (7, "x" * 5000 + " y", "en"),
    (8, "word " * 30000, "en"), (9, "ünï cödé 東京 <|endoftext|> 12.5", "de"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture
def odd(make):
    return make(ODD, SCHEMA).withColumns({c: F.lit(1) for c in ("kind", "key", "n", "ids", "toxicity", "shard")})


@pytest.fixture
def none(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets, root = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, groups):
    """Short and long texts with edits around the threshold."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        size = rng.choice([5, 6, 7, 8, 9, 11, 13, 20, 60, 200])
        base = [rng.choice("abcdefghijkl") + str(rng.randint(0, 40)) for _ in range(size)]
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.randint(0, 1 + size // 40)):
                if rng.random() < 0.5:
                    text[rng.randrange(len(text))] = "edit" + str(rng.randint(0, 9))
                else:
                    text = text + ["tail"] if rng.random() < 0.5 else text[1:] or ["only"]
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_all_pairs(make, seed):
    rows = near_copies(seed, 40)
    got = jaccard_join.jaccard_components(make(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def test_jaccard_light_and_heavy_agree_at_every_boundary(make, monkeypatch):
    rows = near_copies(3, 25)
    for boundary in (0, 4, 9, 12):
        monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *_, b=boundary: b)
        got = jaccard_join.jaccard_components(make(rows, "doc_id long, text string"))
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def test_sketch_bounds_the_overlap():
    rng = np.random.default_rng(1)
    for n, m, both in ((300, 280, 250), (5000, 4000, 100), (20, 20, 20)):
        pool = rng.integers(0, 2**63, n + m, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(pool[:n]), np.unique(pool[n - both : n - both + m])
        bound = jaccard_join.most_overlap(jaccard_join.sketch(a), jaccard_join.sketch(b))
        assert bound is None or bound >= len(np.intersect1d(a, b))


def test_jaccard_odd_rows(odd, none):
    got = jaccard_join.jaccard_components(odd).collect()
    assert len(got) == len(ODD) and jaccard_join.jaccard_components(none).count() == 0
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id))
    assert by_id[1] == {(0, 1)} and by_id[4] == {(1, 4)} and by_id[5] == {(1, 4)} and by_id[8] == {(1, 8)}
    assert by_id[None] == {(2, None)} and by_id[6] == {(2, 6)}
    kept = jaccard_join.keep_one_of_each_group(odd)
    assert kept.columns[0] == "doc_id" and 5 not in [r.doc_id for r in kept.collect()]


def test_components_of_a_chain_and_a_star(make):
    links = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in connected_components(make(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(61)} | {k: 1000 for k in range(1000, 1200)}


def test_bpe_equals_the_library(make, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng, letters = random.Random(5), list("ab cdé'stre 12  \n\t\r\x1c\x85 ​　日本!?<|>ßñ😀") + ["<|endoftext|>", "'ll"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += [r.text for r in docs.limit(50).collect()] + [t for _, t, _ in ODD]
    rows = make(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in prefix_bpe.encoded_digests(rows).collect()}
    for k, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_keeps_columns_and_rows(odd, none):
    back = prefix_bpe.decode(prefix_bpe.encode(odd)).collect()
    assert len(back) == len(ODD) and all(r.decoded == (r.text or "") for r in back)
    assert prefix_bpe.encode(none).count() == 0


def test_bpe_equals_the_library_while_tries_and_memos_start_anew(monkeypatch, none):
    for name, most in (("MOST_NODES", 60), ("MOST_SEGMENTS", 5), ("MOST_PAIRS", 9)):
        monkeypatch.setattr(prefix_bpe, name, most)
    own = prefix_bpe.PrefixBpe(public_tokenizers.path(prefix_bpe.TOKENIZER))
    library = Tokenizer.from_file(public_tokenizers.path(prefix_bpe.TOKENIZER))
    rng = random.Random(5)
    words = ["aaaa", "aaaaaaa", "the", "then", "they're", "naïve", "日本語", "x" * 70, "12345", "…!?", "\n\n", "<|endoftext|>"]
    for _ in range(40):
        texts = [" ".join(rng.choice(words) + rng.choice(["", ",", "ing", "a" * rng.randrange(9)]) for _ in range(12)) for _ in range(3)]
        want = [library.encode(text, add_special_tokens=False).ids for text in texts]
        assert own.encode_batch(texts) == want
        assert [own.decode(ids) for ids in want] == texts
    assert prefix_bpe.encoded_digests(none).count() == 0


def test_digest_index_over_batches(make, odd, none):
    index = new_index(odd.sparkSession)
    first = index.add(make([(1, "a"), (3, "a"), (2, "b"), (2, "b"), (None, None), (9, "")], "doc_id long, text string"), "one")
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in first.collect())
    assert got[0] == (0, 9, 2, False) and got[1] == (1, 3, 2, False) and got[4:] == [(3, 3, 2, True), (9, 9, 2, True)]
    assert sorted(x[3] for x in got[2:4]) == [False, True]
    again = index.add(make([(7, "a"), (8, "c")], "doc_id long, text string"), "two").collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in again) == [(7, 3, False), (8, 8, True)]
    assert index.table().count() == 4 and new_index(odd.sparkSession).add(none, "x").count() == 0
    kept = deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 8, 9]


def test_batch_added_again_keeps_what_it_kept(make, spark):
    rows = [(k, f"text {k % 50}") for k in range(200)] + [(199, "text 49"), (None, "alone"), (None, "alone")]
    batch, index = make(rows, "doc_id long, text string"), new_index(spark)
    index.add(make([(5, "text 0")], "doc_id long, text string"), "zero").count()

    def kept(parts, to):
        got = to.add(batch.repartition(parts, "text"), "one").collect()
        assert len(got) == len(rows)
        return sorted(((r.doc_id or -1, r.keep_id) for r in got if r.kept), key=str)

    first = kept(2, index)
    assert len(first) == 50 and (-1, None) in first
    assert kept(3, index) == first and kept(7, index) == first and index.table().count() == 51
    smaller = index.compacted(buckets=3)
    assert kept(5, smaller) == first and smaller.table().count() == 51


def test_near_copy_stage_leaves_other_texts_of_a_repeated_id(make):
    one = "a b c d e f g h i j k l m n o p q r s t u v w x"
    rows = [(1, one), (5, one + " y"), (5, "wholly other words that nobody else has"), (7, one), (7, one), (None, one), (8, ""), (9, None)]
    kept = jaccard_join.keep_one_of_each_group(make(rows, "doc_id long, text string").withColumn("row", F.lit("own")))
    assert kept.columns == ["doc_id", "text", "row"] and {r.row for r in kept.collect()} == {"own"}
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(1, one), (5, "wholly other words that nobody else has"), (0, one), (8, ""), (9, "")]
    )


def test_repeated_row_is_kept_once(make):
    rows = make([(1, "a", 1), (1, "a", 1), (1, "b", 2), (0, "a", 3), (None, "n", 4), (None, "n", 4)], "doc_id long, text string, x int")
    assert sorted((r.doc_id or 0, r.text) for r in deduplicate(rows).collect()) == [(0, "n"), (1, "a"), (1, "b")]


def test_class_model_counts_and_sums_to_one(docs, odd, none):
    got = {r.doc_id: r for r in class_lm.score_corpus(docs).collect()}
    tokens, counts = {}, collections.Counter()
    for r in docs.collect():
        tokens[r.doc_id] = [*WORD.findall((r.text or "").translate(LOWER)), None]
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update(tokens[r.doc_id])
    total = sum(counts.values())
    held = []
    for d, own in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        assert got[d].base_score == pytest.approx(base) and got[d].n_tokens == len(own) and got[d].train_tokens == total
        assert got[d].n_known == sum(counts[w] > 0 for w in own)
        held += [(got[d].score, base)] * got[d].held_out
    assert sum(s for s, _ in held) > sum(b for _, b in held)
    model, all_counts = class_lm.train(docs.select("text"))
    used = model.mass() > 0
    assert np.allclose((10**model.transition)[:, used].sum(1), 1)
    rows = all_counts.toArrow().to_pandas()
    at = model.table.find(rows["code"].to_numpy(np.int64).view(np.uint64))
    label = np.where(at >= 0, model.labels[at], class_lm.CLASSES)
    mass = np.bincount(label, 10 ** model.emission(rows["n"].to_numpy(), label), class_lm.CLASSES + 1)
    mass[class_lm.CLASSES] += 10 ** model.emission(np.zeros(1), np.array([class_lm.CLASSES]))[0]
    assert np.allclose(mass[used], 1)
    scored = class_lm.score_corpus(odd).collect()
    assert len(scored) == len(ODD) and {r.n_tokens for r in scored if r.doc_id in (1, 2, 3)} == {1}
    assert class_lm.score_corpus(none).count() == 0


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    truth = np.arange(60) % 3
    pairs = rng.poisson(np.where((truth[:, None] + 1) % 3 == truth[None, :], 20, 1))

    def likelihood(label):
        member = np.eye(3)[label]
        grid = member.T @ pairs @ member
        info = lambda x: (x * np.log(np.where(x > 0, x, 1))).sum()
        return info(grid) - info(grid.sum(0)) - info(grid.sum(1))

    order = rng.permutation(60)
    found = class_lm.exchange(pairs[np.ix_(order, order)], 3, 10)
    assert likelihood_of(pairs, order, found, likelihood) >= likelihood(truth) - 1e-6


def likelihood_of(pairs, order, found, likelihood):
    label = np.empty(len(order), dtype=int)
    label[order] = found
    return likelihood(label)


def test_gru_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = byte_gru.ByteGru(["a", "b", "c"], hidden=5)
    net.weights = {k: w.astype(float) for k, w in net.weights.items()}
    symbols, mask = byte_gru.padded([b"hello", b"ab", b"xyz"])
    labels = np.array([0, 2, 1])
    _, found = net.gradients(symbols, mask.astype(float), labels)
    for k, w in net.weights.items():
        at = (int(symbols[1, 0]), 3) if k.startswith("in") else tuple(int(rng.integers(n)) for n in w.shape)
        w[at] += 1e-3
        up = net.gradients(symbols, mask, labels)[0]
        w[at] -= 2e-3
        down = net.gradients(symbols, mask, labels)[0]
        w[at] += 1e-3
        assert found[k][at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-5)


def test_language_of_held_out_documents(docs, odd, none):
    got = byte_gru.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.9 and all(0 <= r.score <= 1 for r in got)
    rows = byte_gru.identify(odd).collect()
    assert len(rows) == len(ODD) and {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert byte_gru.identify(none).count() == 0


def test_misspelled_terms_and_context():
    lexicon = toxicity.Lexicon({"idiot": 1, "worthless": 2, "scum": 0})

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(3)
    for _ in range(300):
        word = list(rng.choice(["idiot", "worthless", "scum", "other"]))
        for _ in range(rng.randint(0, 3)):
            word[rng.randrange(len(word))] = rng.choice(["", "x", "ab"])
        word = "".join(word) or "a"
        want = [edits(word, t) for t, most in (("idiot", 1), ("worthless", 2), ("scum", 0)) if edits(word, t) <= most]
        assert lexicon.distance(word.encode()) == min(want, default=-1)
    plain = toxicity.context_factor(b"such an ", b" indeed")
    assert toxicity.context_factor(b'he said "what an ', b'" to them') < plain < toxicity.context_factor(b"you ", b"!")


def test_toxicity_of_documents(spark, make, odd, none):
    clean = [(k, f"plain text number {k} you are an ordinary one") for k in range(300)]
    bad = [(1000 + k, f"text {k} you are an idiot worthless") for k in range(60)]
    labels = make([(d, int(d >= 1000)) for d, _ in clean + bad] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.train(make(clean + bad, "doc_id long, text string"), labels)
    assert {"idiot", "worthless"} <= set(model.terms) and "plain" not in model.terms
    new = make([(1, "an Idiot!!"), (2, "a w0rthless one"), (3, "quiet text"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.toxicity >= 0.5 for r in toxicity.score(new, model).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}
    scored = toxicity.score(odd, model)
    assert scored.count() == len(ODD) and set(scored.columns) == set(odd.columns)
    assert toxicity.score(none, toxicity.train(none, labels.where("false"))).count() == 0


def test_reparameterised_question_is_caught(make, odd, none):
    item = "A train leaves Boston at 60 mph while another train leaves Denver at 45 mph. How many hours until Boston sees it?"
    other = item.replace("60", "75").replace("45", "50").replace("Boston", "Paris").replace("Denver", "Lyon")
    mixed = other.replace("until Paris", "until Oslo").replace("at 75", "at Nine").replace("Lyon at", "Paris at")
    rows = [(1, "Some words before this. " + item + " And words behind it."), (2, other), (3, "Nothing of the kind here at all, really."),
            (4, None), (5, mixed), (6, item.upper())]
    bench = make([(0, item), (1, None), (2, "")], "item_id long, text string")
    got = {r.doc_id: r.item_id for r in templates.contaminated_pairs(make(rows, "doc_id long, text string"), bench).collect()}
    assert got.get(1) == 0 and got.get(2) == 0 and 3 not in got and 4 not in got
    assert templates.contaminated_pairs(odd, bench).count() == 0
    assert templates.contaminated_pairs(none, bench.where("false")).count() == 0
    assert templates.decontaminate(odd, bench).count() == len(ODD)


def test_planted_items_are_caught(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    flat = lambda text: re.sub(r"\W+", " ", text.lower()).strip()
    items = {r.item_id: flat(r.text) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in flat(r.text or "")}
    got = {(r.doc_id, r.item_id) for r in templates.contaminated_pairs(docs, bench).collect()}
    assert want and want <= got


def test_licence_blocks(make, odd, none):
    rows = [(1, "intro\nReleased under the MIT License.\nmore"), (2, "LICENSED UNDER CC BY-NC 4.0."), (3, "Licensed under CC BY 4.0."),
            (4, "a driver needs a license to drive"), (5, None), (6, "no such words"),
            (7, "x\nThis work is licensed under the GNU General Public License, version 3.")]
    got = {r.doc_id: r for r in licences.scan(make(rows, "doc_id long, text string")).collect()}
    assert {d: r.licence for d, r in got.items() if r.confirmed} == {1: "MIT", 2: "CC-BY-NC-4.0", 3: "CC-BY-4.0", 7: "GPL-3.0"}
    assert got[1].start == 6 and set(got) == {1, 2, 3, 4, 7}
    assert licences.scan(odd).count() == 0 and licences.scan(none).count() == 0


def test_best_fit_equals_a_plain_search():
    rng = random.Random(4)
    for length in (1, 7, 64, 100):
        sizes = [rng.randint(1, length) for _ in range(300)]
        free, rows = [], []
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            fits = [f for f in free if f >= sizes[k]]
            if fits:
                free[free.index(min(fits))] -= sizes[k]
            else:
                free.append(length - sizes[k])
        rows = packing.best_fit_decreasing(sizes, length)
        assert sorted(k for row in rows for k in row) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[k] for k in row) for row in rows) == sorted(free)


def test_packing_round_trip(odd, none):
    rows = packing.pack(odd, length=64, pool_tokens=2000).collect()
    encoder, end = packing.encoding(packing.VOCABULARY)
    parts = collections.defaultdict(list)
    for r in rows:
        ids, positions = np.frombuffer(r.input_ids, "<i4"), np.frombuffer(r.position_ids, "<i4")
        assert len(ids) == len(positions) == 64 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens :] == end).all()
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert positions[a:b].tolist() == list(range(b - a))
            parts[r.doc_ids[k]].append((r.parts[k], ids[a:b].tolist()))
    want = collections.Counter((d, tuple([*encoder.encode_ordinary(t or ""), end])) for d, t, _ in ODD)
    for d in {d for d, _, _ in ODD} - {4}:
        assert want[d, tuple(x for _, ids in sorted(parts[d]) for x in ids)] == 1
    assert len(parts[4]) == 2 and packing.pack(none).count() == 0


def test_table_is_even_and_stable(odd, none):
    table = sharding.fill_table(sharding.SHARDS, sharding.SLOTS)
    shares = collections.Counter(table)
    assert len(shares) == 64 and max(shares.values()) - min(shares.values()) <= 1
    fewer = sharding.fill_table(sharding.SHARDS[:-1], sharding.SLOTS)
    assert sum(a != b for a, b in zip(table, fewer) if a != 63) < 0.05 * len(table)
    placed = sharding.place(odd, spread_by="text")
    assert placed.count() == len(ODD) and placed.columns.count("shard") == 1 and sharding.place(none).count() == 0
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 12)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    columns = want.columns
    got = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_covers_the_table(spark, docs, name):
    got = QUERIES[name](spark, SMALL)
    if name.split("_")[0] in ("op3", "op4", "op5", "op9"):
        assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.collect())
    else:
        assert got.count() > 0


def test_words_do_not_depend_on_the_block(monkeypatch):
    texts = pa.array(["One two  three four five six", "", None, "x" * 70 + " é ü", "a\tb\nc d e f g h i"])
    piece = next(corpus.text_pieces(texts))
    whole = corpus.byte_words(piece)
    monkeypatch.setattr(corpus, "BLOCK_WORDS", 2)
    assert all(np.array_equal(a, b) for a, b in zip(whole, corpus.byte_words(piece), strict=True))


def test_dedup_keeps_a_column_named_row(spark):
    rows = spark.createDataFrame([(1, "a", 7), (2, "a", 8), (3, None, 9)], "doc_id long, text string, row int")
    assert sorted((r.doc_id, r.row) for r in deduplicate(rows).collect()) == [(2, 8), (3, 9)]


def test_small_batches_keep_a_smaller_setting(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 10)
    corpus.small_batches(spark)
    assert spark.conf.get(setting) == "10"
    spark.conf.set(setting, 5000)
    corpus.small_batches(spark)
    assert spark.conf.get(setting) == str(corpus.BATCH_ROWS)
    spark.conf.set(setting, before)


def test_wrapped_whole_and_neighbouring_licences(make):
    import textwrap

    whole = lambda name: licences.NOTICES[f"{name}-whole"]
    wrap = lambda text, mark="": "\n".join(mark + line for line in textwrap.wrap(text, 60))
    mpl = "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy was not given */"
    texts = {
        1: ("code\n\n" + wrap(licences.NOTICES["MIT-text"], "# ") + "\nmore", {"MIT-text"}),
        2: (wrap(licences.NOTICES["BSD-opening"]), {"BSD-opening"}),
        3: ("x\n" + mpl, {"MPL-2.0"}),
        4: ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        5: ("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        6: ("words " * 300 + wrap(whole("BSD-2-Clause"), " * ") + " words" * 300, {"BSD-2-Clause-whole"}),
        7: (wrap(whole("BSD-3-Clause")), {"BSD-3-Clause-whole"}),
        8: (wrap(whole("BSD-4-Clause")), {"BSD-4-Clause-whole"}),
        9: (whole("0BSD") + "\n\n" + wrap(whole("ISC"), "// "), {"0BSD-whole", "ISC-whole"}),
        10: (whole("MIT"), {"MIT-whole"}),
        11: ("Licensed under CC BY-SA 4.0 or CC BY 4.0.", {"CC-BY-SA-4.0", "CC-BY-4.0"}),
        12: (whole("GPL-3.0"), {"GPL-3.0-whole"}),
        13: ("This work is licensed under the GNU Lesser General Public License, version 3.", {"LGPL-3.0"}),
        14: ("under a licence of the kind", set()),
    }
    got = collections.defaultdict(set)
    rows = [(k, t) for k, (t, _) in texts.items()]
    for r in licences.scan(make(rows, "doc_id long, text string")).collect():
        got[r.doc_id] |= {r.licence} if r.confirmed else set()
        assert texts[r.doc_id][0][r.start : r.start + len(r.block)] == r.block
    assert {k: got[k] for k in texts} == {k: want for k, (_, want) in texts.items()}
    long = " ".join(f"term{k}" for k in range(400))
    found = licences.NoticeRanker({"own": long, "other": "copyright by nobody at all"}).scan(f"a {long} z")
    assert [(start, v.licence, v.confirmed) for start, _, v in found] == [(2, "own", True)]


def test_slot_dense_short_and_capitalised_items(make):
    items = [
        "What is 12 + 7 - 3 * 2 / 5?", "Compute 17 * 24 + 3 - 8.", "Convert 5 miles 3 yards 2 feet to inches.",
        "Which is larger, 3 km 20 m or 2 miles 5 yards?", "Photosynthesis", "Boston is older", "How green are Swiss valleys",
    ]
    rows = [(k, f"we were asked {text} and so on") for k, text in enumerate(items)]
    rows += [(10 + k, f"before: {text.lower()} behind") for k, text in enumerate(items)]
    rows += [(20, "Compute 18 * 25 + 4 - 9."), (21, "What is 13 + 8 - 4 * 3 / 6?"), (22, "So green are Swiss valleys"), (23, "we know that Paris is older")]
    bench = make(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in templates.contaminated_pairs(make(rows, "doc_id long, text string"), bench).collect()}
    assert found == {(d + k, k) for k in range(len(items)) for d in (0, 10)} | {(23, 5)}


def test_rare_short_and_sign_filled_terms(make):
    clean = [(k, f"plain text number {k} you are an ordinary one, well-known") for k in range(3000)]
    bad = [(5000 + k, f"text {k} you are a scum idiot") for k in range(1960)] + [(8000 + k, "a rareslur here") for k in range(39)]
    labels = make([(d, int(d >= 5000)) for d, _ in clean + bad], "doc_id long, toxic int")
    bad = [(d, f"{t} {d}") for d, t in bad]
    model = toxicity.train(make(clean + bad, "doc_id long, text string"), labels)
    assert {"scum", "idiot", "rareslur"} <= set(model.terms) and model.terms["scum"] == 1
    texts = ["a rareslur", "such scvm", "such scumm", "an id!ot", "an i.d.i.o.t", "(an id*ot)", "a well-known one", "i d i o t"]
    got = toxicity.score(make(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert [r.toxicity >= 0.5 for r in sorted(got)] == [True] * 6 + [False] * 2


def test_ends_of_texts_rarer_than_the_core(make):
    words = [f"w{k}" for k in range(1000)] * 4 + [f"r{k}" for k in range(100)] * 2
    rows = [(k, " ".join(words)) for k in range(3)]
    model, _ = class_lm.train(make(rows, "doc_id long, text string").select("text"))
    assert model.tokens == 3 * (len(words) + 1)
    # Most of the words are in the core and more frequent than the ends of the texts.
    scored = class_lm.score_corpus(make([(k, t) for k, (_, t) in enumerate(rows * 3)], "doc_id long, text string")).collect()
    assert len(scored) == 9 and all(math.isfinite(r.score) and r.score < 0 for r in scored)


def test_words_outside_the_broadcast_table_have_classes(make, monkeypatch):
    # 3000 words of two kinds that alternate; the table and the core hold a few of them.
    monkeypatch.setattr(class_lm, "TABLED", 300)
    monkeypatch.setattr(class_lm, "CORE", 120)
    rng = np.random.default_rng(5)
    draw = lambda: int(min(1499, rng.pareto(0.6) * 3))
    texts = [" ".join(f"{'ab'[k % 2]}{draw()}" for k in range(60)) for _ in range(400)]
    texts += ["z1 z2 z3 z1 z2 z3", "", "new words only", "z2 new z2 a1"]
    frame = make(list(enumerate(texts)), "doc_id long, text string")
    model, words = class_lm.train(make([(t,) for t in texts[:402]], "text string"))
    assert len(model.table.codes) <= 300
    column = pa.array(texts)
    codes = [c for _, _, c, _ in class_lm._sequences(column)]
    trained = np.concatenate([c for _, _, c, _ in class_lm._sequences(column.slice(0, 402))])
    found = words.toArrow().to_pandas()
    own = dict(zip(found["code"].to_numpy(np.int64).view(np.uint64).tolist(), zip(found["n"], found["class"])))
    table = dict(zip(model.table.codes.tolist(), model.labels.tolist()))
    label = {c: table.get(c, int(k) if k == k else class_lm.CLASSES) for c, (_, k) in own.items()}
    # Each word met twice has a class of its own kind, in the table or not.
    assert sum(n > 1 and c not in table for c, (n, _) in own.items()) > 300
    assert all((n > 1) == (label[c] < class_lm.CLASSES) for c, (n, _) in own.items())
    names = {int(c): w for w, c in zip(" ".join(texts).split(), [c for s in codes for c in s if c != class_lm.END])}
    kinds = collections.defaultdict(collections.Counter)
    for c, (n, _) in own.items():
        if n > 1 and c not in table and names[c][0] in "ab":
            kinds[label[c]][names[c][0]] += 1
    assert sum(max(k.values()) for k in kinds.values()) > 0.97 * sum(map(sum, map(collections.Counter.values, kinds.values())))
    # Transitions, weights of classes and scores are those of a count over all words with these classes.
    width = class_lm.CLASSES + 1
    steps, before = np.zeros((width, width)), int(class_lm.END)
    for c in trained.tolist():
        steps[label[before], label[c]] += 1
        before = c
    sizes = np.bincount(list(label.values()), minlength=width)
    assert (model.class_words == sizes).all() and model.class_tokens.sum() == len(trained)
    used = (sizes > 0) | (np.arange(width) == class_lm.CLASSES)
    steps = (steps + class_lm.TRANSITION_PRIOR) * used
    steps = np.log10(np.maximum(steps / steps.sum(1, keepdims=True), 1e-300))
    assert np.allclose(model.transition, steps)
    got = {r.doc_id: r for r in class_lm.score(frame, model, words).collect()}
    start = 0
    flat = np.concatenate(codes).tolist()
    for k in range(len(texts)):
        end = flat.index(int(class_lm.END), start) + 1
        score, base, last = 0.0, 0.0, label[int(class_lm.END)]
        for c in flat[start:end]:
            n, here = own.get(c, (0, 0))[0], label.get(c, class_lm.CLASSES)
            score += steps[last, here] + model.emission(np.array([n]), np.array([here]))[0]
            base += math.log10((n + 1) / (model.tokens + model.words + 1))
            last = here
        assert got[k].score == pytest.approx(score) and got[k].base_score == pytest.approx(base)
        assert got[k].n_known == sum(c in own for c in flat[start:end])
        start = end


def test_pairs_of_tokens_are_judged_by_the_merges_that_made_them(monkeypatch):
    own = prefix_bpe.PrefixBpe(public_tokenizers.path(prefix_bpe.TOKENIZER))
    rng = random.Random(11)
    tokens = sorted(own.ids.values())
    pairs = [tuple(rng.sample(tokens, 2)) for _ in range(3000)] + [(t, t) for t in rng.sample(tokens, 500)]
    # Cuts of real tokens and of joined ones, so that merges across the seam are met.
    for t in rng.sample(tokens, 4000):
        text = own.bytes_of[t] + own.bytes_of[rng.choice(tokens)]
        cut = rng.randint(1, len(text) - 1)
        left, right = own._merged(text[:cut])[-1], own._merged(text[cut:])[0]
        pairs.append((own.ids[left], own.ids[right]))
    truth = [own._merged(own.bytes_of[a] + own.bytes_of[b]) == [own.bytes_of[a], own.bytes_of[b]] for a, b in pairs]
    assert 500 < sum(truth) < len(truth) - 500
    merged, calls = own._merged, collections.Counter()
    monkeypatch.setattr(own, "_merged", lambda text: calls.update([text]) or merged(text))
    assert [own._may_follow(a, b) for a, b in pairs] == truth
    # Bytes are merged once for each token and not for each pair.
    assert set(calls) <= set(own.ids) and max(calls.values()) == 1


def test_bpe_states_of_a_level_are_set_together(docs, monkeypatch):
    own = prefix_bpe.PrefixBpe(public_tokenizers.path(prefix_bpe.TOKENIZER))
    library = Tokenizer.from_file(public_tokenizers.path(prefix_bpe.TOKENIZER))
    texts = [r.text or "" for r in docs.collect()]
    texts += ["a a\0 a\0\0 a\0b ab abc", "the them themes. thé thê, they're; \0", "x" * 48 + " " + "x" * 49 + ".", "", " ", "<|endoftext|>"]
    state, calls = own._state, collections.Counter()
    monkeypatch.setattr(own, "_state", lambda *given: calls.update(one=1) or state(*given))
    ids = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert own.encode_batch(texts) == ids
    words = {w.encode() for text in texts for w in own.split.findall(text)}
    nodes = {w[:end] for w in words if len(w) <= prefix_bpe.LONGEST_KEPT for end in range(1, len(w) + 1)}
    # Few of them are decided one by one.
    assert len(nodes) > 20_000 and calls["one"] < len(nodes) / 3, (calls, len(nodes))
    shown = [(",".join(map(str, row)), text.encode()) for row, text in zip(ids, texts, strict=True)]
    assert list(own.shown_batch(texts)) == shown
    # All words are known now.
    before = calls["one"]
    assert list(own.shown_batch(texts[::-1])) == shown[::-1] and calls["one"] == before


def test_bpe_knows_the_letters_that_the_library_knows():
    own = prefix_bpe.PrefixBpe(public_tokenizers.path(prefix_bpe.TOKENIZER))
    library = Tokenizer.from_file(public_tokenizers.path(prefix_bpe.TOKENIZER))
    # Every code point behind a letter and a number and before a contraction.
    points = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x3FFFF, 3))]
    texts = ["".join(f"a{c}'s1{c}'ll {c}2 " for c in points[k : k + 2000]) for k in range(0, len(points), 2000)]
    for text in texts:
        want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert own.split.findall(text) == want
    text = "a\U0001094a'll \ua7ce's 2\U00011de0 \U000323b0're"
    assert own.encode_batch([text]) == [library.encode(text, add_special_tokens=False).ids]
