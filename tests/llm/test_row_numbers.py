"""Row numbers of the pipeline's stages hold when files are split otherwise between a stage's two reads."""

import pytest

import corpus_pipeline as cp
from curbline.llm.common import written

SPLITS = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "1"}


@pytest.mark.parametrize("stage", [cp.unlike, cp.unrepeated])
def test_numbers_hold_when_splits_change(spark, stage):
    texts = [" ".join(f"d{k}w{j}" for j in range(80)) for k in range(24)]
    texts += texts[:6]  # the later of each pair goes or loses its text
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    docs = written(docs.repartition(12, "doc_id"), "docs")
    same = lambda df: sorted((r.text, r.n_chars) for r in df.collect())
    want = same(stage(spark, docs, ""))
    lazy = stage(spark, docs, "")
    try:
        for k, v in SPLITS.items():
            spark.conf.set(k, v)
        assert same(lazy) == want
    finally:
        for k in SPLITS:
            spark.conf.unset(k)
    if stage is cp.unlike:
        assert len(want) == len(set(texts)) and {t for t, _ in want} == set(texts)
