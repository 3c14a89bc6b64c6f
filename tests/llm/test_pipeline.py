"""The pipeline's stages on the smallest data, each held against a brute-force version."""

import re

import corpus_pipeline
from tallyforge.llm import toxicity
from tallyforge.llm.corpus import documents

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    from tests.llm.test_operators import brute_components

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "bpe"]
    docs = documents(spark, SMALL)
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), None if name == "bpe" else docs.schema)
        after = {r.doc_id for r in docs.collect()}
        seen.append(len(after))
        if name == "toxicity":
            model = toxicity.train(documents(spark, SMALL), toxicity.labelled_rows(spark, SMALL))
            gone = [before[d] for d in before.keys() - after]
            assert all(any(re.search(t, text, re.I) for t in model.terms) for text in gone)
        elif name == "exact_dedup":
            assert after == {max(d for d in before if before[d] == t) for t in set(before.values())}
        elif name == "jaccard_join":
            assert after == {d for d, (_, root) in brute_components(list(before.items())).items() if d == root}
        elif name == "decontamination":
            assert after <= before.keys()
        else:
            assert after == before.keys() and docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if name != "bpe":
            assert docs.columns == columns
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
