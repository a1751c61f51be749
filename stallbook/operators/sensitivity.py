"""What removing duplicates does to sales, cancellations and net value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions.numbers import times_copies
from stallbook.functions.rates import percentage
from stallbook.operators.lines import COPIES
from stallbook.operators.metrics import base_sums, difference, total, with_derived

SUMS = ["positive_sales_gbp", "cancellation_value_gbp", "other_negative_value_gbp"]
COMPARED = ["positive_sales_gbp", "cancellation_value_gbp", "net_value_gbp"]


def with_every_copy(lines: DataFrame) -> DataFrame:
    """Classified lines valued as if duplicates had been kept."""
    return lines.withColumn(
        "signed_value_gbp", times_copies(F.col("signed_value_gbp"), F.col(COPIES))
    )


def sums_before() -> list[Column]:
    """S, C and A of classified lines with all their copies."""
    copied = times_copies(F.col("signed_value_gbp"), F.col(COPIES))
    return [
        column.alias(f"before_{name}") for name, column in zip(SUMS, base_sums(copied))
    ]


def comparison_table(totals: DataFrame) -> DataFrame:
    """Three metrics before and after deduplication; totals hold both, at any grain."""
    after = [total(F.col(name)).alias(name) for name in SUMS]
    before = [total(F.col(f"before_{name}")).alias(name) for name in SUMS]
    sides = F.array(
        F.struct(F.lit("before").alias("side"), *before),
        F.struct(F.lit("after").alias("side"), *after),
    )
    rows = with_derived(
        totals.agg(sides.alias("sides")).select(F.inline("sides"))
    ).unpivot("side", COMPARED, "metric", "value")
    compared = rows.groupBy("metric").agg(
        F.max(F.when(F.col("side") == "before", F.col("value"))).alias("before_gbp"),
        F.max(F.when(F.col("side") == "after", F.col("value"))).alias("after_gbp"),
    )
    return (
        compared.withColumn(
            "change_gbp", difference(F.col("after_gbp"), F.col("before_gbp"))
        )
        .withColumn(
            "percentage_change", percentage(F.col("change_gbp"), F.col("before_gbp"))
        )
        .orderBy(F.array_position(F.array(*[F.lit(name) for name in COMPARED]), F.col("metric")))
    )


def duplicate_comparison(lines: DataFrame) -> DataFrame:
    return comparison_table(lines.agg(*base_sums(), *sums_before()))
