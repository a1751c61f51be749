"""Helpers that the operators share: input columns, checked broadcasts, row removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.storage import written

#: A side of a join is broadcast only when it is counted to have at most so many rows of a few
#: numbers or one digest each, which is a few tens of megabytes at most.
BROADCAST_ROWS = 500_000
#: Bytes of rows that Python workers get at once, beyond which a batch ends. Spark's own limits, 10,000 rows and 64 MB,
#: let each task hold several copies of tens of megabytes of text, beside the heap and in its worker.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_small_batches(docs: DataFrame) -> DataFrame:
    """docs; what its session plans from now on sends them to Python workers in batches of about BATCH_BYTES."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only id and text, so that no other column of the input can clash with a new one."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def join_side(stored: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows are few; else Spark shuffles."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until docs has no column of that name in any case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def without_rows(docs: DataFrame, dropped: DataFrame, mark: Column, id_column: str = "doc_id") -> DataFrame:
    """docs without the rows named by dropped (doc_id, mark).

    A doc_id alone need not be unique, so rows are named by doc_id and a mark computed from their
    text. Nulls are equal to each other. docs may have further columns of any name and type.
    """
    name, of = fresh(docs, "dropped_id", "dropped_mark")
    side = join_side(written(dropped.select("doc_id", "mark"), "dropped")).select(
        F.col("doc_id").alias(name), F.col("mark").alias(of)
    )
    same = F.col(id_column).eqNullSafe(F.col(name)) & mark.eqNullSafe(F.col(of))
    return docs.join(side, same, "left_anti")


def _comparable(field: T.StructField) -> Column:
    """The column itself, or as JSON if values of its type have no order."""
    column = F.col(f"`{field.name}`")
    unordered = any(word in field.dataType.simpleString() for word in ("map<", "variant", "interval"))
    return F.to_json(F.struct(column)) if unordered else column


def first_of_repeats(docs: DataFrame, repeated: DataFrame, mark: Column, id_column: str = "doc_id") -> DataFrame:
    """One row, the least over all columns, for each (doc_id, mark) in repeated.

    repeated names rows that share doc_id and mark, such as the same record read twice. All
    other rows of docs pass unchanged; without repeats docs is returned as it is. Columns may have any
    name and type; maps and the like are compared as JSON.
    """
    stored = written(repeated.select("doc_id", "mark"), "repeated")
    if stored.isEmpty():
        return docs
    name, of, row = fresh(docs, "repeated_id", "repeated_mark", "repeated_row")
    side = stored.select(F.col("doc_id").alias(name), F.col("mark").alias(of))
    same = F.col(id_column).eqNullSafe(F.col(name)) & mark.eqNullSafe(F.col(of))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = (
        docs.join(side, same, "left_semi")
        .groupBy(F.col(id_column).alias(name), mark.alias(of))
        .agg(F.min_by(whole, F.struct(*map(_comparable, docs.schema))).alias(row))
        .select(f"{row}.*")
    )
    return docs.join(side, same, "left_anti").unionByName(least)
