"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that the one before kept and returns those it keeps, all columns
unchanged; the last packs them into sequences. Cases such as nulls, repeats and empty tables are those
of the operators.

* language: documents whose language is rejected go; others keep their own `lang`.
* exact: one document of equal texts stays, the one with the smallest doc_id.
* near: one document of each SimHash component stays, the one with the smallest doc_id.
* benchmark: documents that overlap a benchmark item go.
* packing: one row per piece of a document, with its sequence and place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stallbook.llm.decontam import keep_clean
from stallbook.llm.exact import deduplicate
from stallbook.llm.language import keep_identified
from stallbook.llm.packing import sequences
from stallbook.llm.simhash import keep_first
from stallbook.llm.tables import table
from stallbook.storage import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sequences(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("benchmark", benchmark),
    ("packing", packing),
]

#: Compression, word hashes and tokens are beyond SQL. tests/llm compares the methods of exact, near, benchmark and packing with
#: brute force, language with given labels, and the pipeline with its stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
