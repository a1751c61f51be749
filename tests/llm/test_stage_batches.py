"""Stages that give texts to Python workers do so in batches bounded by bytes."""

import pytest

import corpus_pipeline
from stallbook.llm import decontam
from stallbook.llm.tables import BATCH_BYTES
from stallbook.storage import written

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("stage", ["language", "near", "benchmark", "packing"])
def test_stages_with_texts_in_python_bound_their_batches(spark, tmp_path, stage):
    docs = spark.createDataFrame(
        [(n, f"some words of a text number {n}", "en", "web") for n in range(8)], "doc_id long, text string, lang string, source string"
    )
    spark.createDataFrame([(1, "five other words stand here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.conf.unset(SETTING)
    dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path)).collect()
    assert int(spark.conf.get(SETTING).removesuffix("b")) <= BATCH_BYTES
    spark.conf.unset(SETTING)


def test_overlaps_are_found_in_one_worker_for_each_task(spark, monkeypatch):
    """A filter on what a Python function returns does not make Spark run it once more below."""
    plans = []

    def recorded(df, name, by=None):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")))
        return written(df, name, by)

    monkeypatch.setattr(decontam, "written", recorded)
    text = " ".join(f"word{n}" for n in range(30))
    docs = spark.createDataFrame([(1, f"before {text} behind"), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    assert [r["doc_id"] for r in decontam.keep_clean(docs, items).collect()] == [2]
    assert {n: k for n, k in plans if k} == {"items": 1, "candidates": 1, "overlaps": 1}
