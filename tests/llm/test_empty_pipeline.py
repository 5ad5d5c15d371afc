"""The pipeline over empty tables."""

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_no_labels_and_no_benchmark(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(30).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    docs = cp.documents(spark, str(tmp_path))
    assert cp.toxicity_stage(spark, docs, str(tmp_path)).count() == 30
    assert cp.decontamination_stage(spark, docs, str(tmp_path)).count() == 30
