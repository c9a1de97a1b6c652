"""The pipeline against its stages done plainly, one after the other."""

import hashlib
from collections import Counter

import public_tokenizers
from test_llm_dedup import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from hammerline.llm import mixing, toxicity


def test_stages_have_effect_and_follow_each_other(spark):
    sf = "/root/testdata/sf0.01"  # the smallest tables have too few labels to learn from
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 1").collect()}
    clean = {i: t for i, t in texts.items() if i not in toxic}
    last = {}
    for i, t in sorted(clean.items()):
        last[t.encode().lower()] = i
    once = {i: clean[i] for i in last.values()}
    near = plain_components(list(once), [plain_fingerprint(t) for t in once.values()], 2)
    kept = sorted({near[i] for i in once})
    assert toxic and len(kept) < len(texts)

    state = docs
    expected = [set(clean), set(once), set(kept)]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected):
        state = stage(spark, state, sf)
        assert state.columns == docs.columns
        rows = state.collect()
        assert {r.doc_id for r in rows} == ids and len(rows) == len(ids), name
    copies = {r.doc_id: r.copies for r in mixing.mix(state).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, n in copies.items():
        ids = library.encode(texts[i], add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[i, len(ids), digest, hashlib.sha256(texts[i].encode()).hexdigest()] += n
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == +want


def test_empty_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    state = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, sf)
        assert state.count() == 0
