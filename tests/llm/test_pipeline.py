"""The pipeline's stages against what their operators say one by one."""

from collections import Counter

import corpus_pipeline
from ladderweek.llm import cotraining, mixing, near_dedup, perplexity

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_decide(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    columns, ids = docs.columns, lambda rows: Counter(r.doc_id for r in rows)
    decided = (
        lambda d: ids(r for r in perplexity.judge(d).collect() if r.kept),
        lambda d: ids(r for r in cotraining.classify(d, labels).collect() if r.kept),
        lambda d: Counter({r.component_id: 1 for r in near_dedup.near_components(d).collect()}),
        lambda d: +Counter({r.doc_id: r.copies for r in mixing.mix(d).collect()}),
    )
    for k, ((_, stage), wanted) in enumerate(zip(corpus_pipeline.STAGES, decided, strict=False)):
        expected = wanted(docs)
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        assert ids(docs.collect()) == expected
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == ids(docs.collect())


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near-duplicates", "mixing", "packing"]
