"""The pipeline's stages against brute force on what their classifiers let through."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_near_dup import brute


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == spark.read.parquet(f"{sf_dir}/documents.parquet").columns
        rows = {r["doc_id"] for r in docs.collect()}
        assert rows <= {i for i, _ in before}
        kept[name] = rows
        if name == "near_duplicates":
            assert rows == {i for i, (_, c) in brute(before).items() if i == c}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in pieces.collect()} == kept["decontamination"]
