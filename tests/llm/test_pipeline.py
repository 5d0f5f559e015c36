"""The pipeline's stages over the smallest tables."""

import corpus_pipeline as P


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    kept = docs
    for _, stage in P.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count()
    packed = P.STAGES[-1][1](spark, kept, sf)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}
