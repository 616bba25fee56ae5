"""The pipeline's stages on empty tables and on columns whose names clash with the operators' own."""

import corpus_pipeline


def test_stages_on_few_odd_rows(spark, make, small):
    docs = make([(1, None), (2, ""), (None, "one text of some words that stays as it is"), (None, "another text of other words which stays too"), (3, "x")])
    names, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[1:4]:
        kept = stage(spark, kept, small)
        assert kept.columns == names, name
        assert sorted(str(r.text) for r in kept.collect()) == sorted(str(r.text) for r in docs.collect()) or name == "suffix_dedup"
        assert kept.count() == 5
    assert corpus_pipeline.STAGES[4][1](spark, kept, small).select("doc_id", "doc_tokens").count() == 5


def test_stages_on_an_empty_table(spark, make, small):
    docs = make([(1, "x")]).limit(0)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, small).count() == 0
