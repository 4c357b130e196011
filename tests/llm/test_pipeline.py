"""The pipeline against brute force: each stage on its own input."""

import os

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@needs_data
def test_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline
    from fundlake.session import stored
    from tests.llm.test_contracts import check_spans, shingle_set

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("extra", F.lit(1)).withColumn("label", F.lit("x"))
    names, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, FOLDER), name)
        assert out.columns == names and out.dtypes == docs.dtypes
        given, got = {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in out.collect()}
        assert got.keys() <= given.keys()
        if name == "span_dedup":
            check_spans(docs)
            assert got.keys() == given.keys()
            for k, r in got.items():
                assert r["n_chars"] == len(r["text"]) or r == given[k]
                assert r["extra"] == 1 and r["label"] == "x" and r["lang"] == given[k]["lang"]
        else:
            assert all(got[k] == given[k] for k in got)
        if name == "exact_dedup":
            keys = {"".join(r["text"].split()) for r in given.values()}
            assert len(got) == len(keys)
        if name == "near_dedup":
            sets = {k: shingle_set(r["text"], 5) for k, r in got.items()}
            for a in sets:
                for b in sets:
                    if a < b and sets[a] and sets[b]:
                        both = len(sets[a] & sets[b])
                        assert 100 * both < 80 * (len(sets[a]) + len(sets[b]) - both)
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


@needs_data
def test_clean_documents_stay(spark):
    import corpus_pipeline

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.remove_toxic(spark, docs, FOLDER)
    clean = docs.join(labels.where("toxic = 0"), "doc_id")
    lost = clean.join(kept, "doc_id", "left_anti").count()
    assert lost <= 0.03 * clean.count()
