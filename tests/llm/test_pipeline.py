import corpus_pipeline
from voicetide.llm import base, line_templates, packing, prob_minhash, quality, toxicity


def test_stages_work_on_what_is_left(spark, small):
    docs = base.table(spark, small, "documents")
    labels = base.table(spark, small, "labels")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = base.written(stage(spark, seen, small), name)
        assert out.columns == docs.columns
        if name == "toxicity":
            want = toxicity.judge(seen, labels).filter("predicted = 0").select("doc_id")
        elif name == "quality":
            want = quality.judge(seen).filter("kept").select("doc_id")
        elif name == "line_dedup":
            want = line_templates.dedup(seen).select("doc_id", "text")
            assert all(len(r.text) == r.n_chars for r in out.collect())
        else:
            want = prob_minhash.classify(seen).filter("kept").select("doc_id")
        assert sorted(out.select(*want.columns).collect()) == sorted(want.collect())
        assert 0 < out.count() <= seen.count()
        seen = out
    packed = corpus_pipeline.pack(spark, seen, small).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in seen.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "line_dedup", "near_dedup", "packing"]
    total = sum(r.length for r in packed)
    assert total == sum(r.doc_tokens for r in packed if r.start == 0)
    assert packing.MAX_TOKENS == max(r.length for r in packed)


def test_stages_on_edge_cases(spark, edge, nothing, small):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge, small).columns == edge.columns
        assert stage(spark, nothing, small).count() == 0
    assert corpus_pipeline.pack(spark, nothing, small).count() == 0
