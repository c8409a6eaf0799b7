"""The pipeline's contract."""

from __future__ import annotations

import inspect

import corpus_pipeline


def test_stages_take_session_documents_and_folder():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_stages_pass_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, None), (None, "a b c d e f")], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    now = odd
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, str(tmp_path))
        if name != "best_fit_packing":
            assert after.schema == odd.schema
            now = after
    assert after.count() >= 1


def test_stages_pass_an_empty_table(spark, nothing, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, str(tmp_path)).collect() == []
