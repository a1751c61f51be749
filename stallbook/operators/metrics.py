"""Sales, cancellations, other negatives and net value of classified lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions.rates import percentage
from stallbook.schema import CANCELLATION, MONEY, OTHER_NEGATIVE, POSITIVE_SALE

RATE = "cancellation_value_rate_pct"


def total(value: Column) -> Column:
    """Exact sum; of no rows it is zero, not null."""
    return F.coalesce(F.sum(value), F.lit(0)).cast(MONEY)


def of_category(name: str, value: Column | None = None) -> Column:
    value = F.col("signed_value_gbp") if value is None else value
    return F.when(F.col("transaction_category") == name, value)


def base_sums(value: Column | None = None) -> list[Column]:
    """S, C and A; they add up over groups, unlike the columns derived from them."""
    return [
        total(of_category(POSITIVE_SALE, value)).alias("positive_sales_gbp"),
        (-total(of_category(CANCELLATION, value))).cast(MONEY).alias("cancellation_value_gbp"),
        (-total(of_category(OTHER_NEGATIVE, value))).cast(MONEY).alias(
            "other_negative_value_gbp"
        ),
    ]


def resums() -> list[Column]:
    """Sum S, C and A of groups into larger groups."""
    return [
        total(F.col(name)).alias(name)
        for name in (
            "positive_sales_gbp",
            "cancellation_value_gbp",
            "other_negative_value_gbp",
        )
    ]


def difference(first: Column, *others: Column) -> Column:
    """Exact first - others; at full width the subtraction itself would drop a decimal."""
    narrow = "decimal(36,9)"
    result = first.cast(narrow)
    for other in others:
        result = (result - other.cast(narrow)).cast(narrow)
    return result.cast(MONEY)


def net() -> Column:
    return difference(
        F.col("positive_sales_gbp"),
        F.col("cancellation_value_gbp"),
        F.col("other_negative_value_gbp"),
    )


def with_derived(sums: DataFrame) -> DataFrame:
    """Add net value and cancellation rate to S, C and A."""
    return sums.withColumn("net_value_gbp", net()).withColumn(
        RATE, percentage(F.col("cancellation_value_gbp"), F.col("positive_sales_gbp"))
    )


def metrics(lines: DataFrame) -> DataFrame:
    """One row, also for an empty population."""
    return with_derived(lines.agg(*base_sums()))


def sums_by(lines: DataFrame, *keys: Column | str, extra: list[Column] = ()) -> DataFrame:
    """S, C, A and line count of each key that has an eligible line, null key included."""
    return (
        lines.groupBy(*keys)
        .agg(*base_sums(), F.count("transaction_category").alias("lines"), *extra)
        .where(F.col("lines") > 0)
    )


def metrics_by(lines: DataFrame, key: str) -> DataFrame:
    """One row for each key, cancellation-only groups included."""
    return with_derived(sums_by(lines, key).drop("lines"))


def category_counts(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy("transaction_category")
        .agg(F.count("transaction_category").alias("row_count"))
        .where(F.col("row_count") > 0)
    )
