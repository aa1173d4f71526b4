"""The pipeline against its stages' brute-force rules on the smallest table."""

import hashlib

import corpus_pipeline
from tallgrass.llm import bpe, common


def test_stages_on_the_small_table(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    cols, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        after = common.durable(stage(spark, docs, sf_dir), "test")
        if stage is not corpus_pipeline.tokens:
            assert after.columns == cols
            assert after.count() <= before and after.join(docs, "doc_id", "left_anti").count() == 0
        if stage is corpus_pipeline.decontamination:
            items = [r.text for r in common.table(spark, sf_dir, "benchmark").collect()]
            kept = {r.doc_id for r in after.collect()}
            for r in docs.collect():
                if any(i in r.text for i in items):
                    assert r.doc_id not in kept
        last, docs, before = docs, after, after.count()
    codec = bpe.Codec(bpe.tokenizer_path())
    texts = {r.doc_id: r.text or "" for r in last.collect()}
    for r in docs.collect():
        ids = codec.tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    assert docs.count() == len(texts)
