"""The pipeline's stages, each on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    import __spark_entry__

    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scans", "mixing sources", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in P.STAGES:
        out = P.saved(stage(spark, docs, FOLDER), "test")
        if name != "packing":
            assert out.columns == docs.columns
        if name in ("quality classifier", "n-gram Jaccard join"):
            assert out.subtract(docs).count() == 0 and out.count() <= docs.count()
        if name == "secret scans":
            assert out.count() == docs.count()
            assert out.filter(F.col("text").rlike("AKIA[A-Z0-9]{16}|[0-9a-f]{24}")).count() == 0
        if name == "mixing sources":
            assert out.subtract(docs).count() == 0
            assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
        docs = out
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_odd_rows_and_no_rows(spark, docs, no_docs, stage):
    got = stage(spark, docs, FOLDER)
    assert got.count() >= 0
    assert stage(spark, no_docs, FOLDER).count() == 0
