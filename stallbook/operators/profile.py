"""Quality profile of the raw rows; its checks may overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import dates, numbers
from stallbook.operators.lines import COPIES
from stallbook.schema import RAW_COLUMNS

# The counts of the profile, in the order they are reported.
COUNTS = [
    "exact_duplicates_beyond_first",
    "c_prefixed_invoice_rows",
    "negative_quantity_rows",
    "negative_quantity_without_c_prefix",
    "c_prefixed_nonnegative_quantity_rows",
    "zero_price_rows",
    "negative_price_rows",
    "zero_quantity_rows",
    "invalid_or_nonfinite_quantity_rows",
    "invalid_or_nonfinite_price_rows",
    "nonintegral_quantity_rows",
    "invalid_or_missing_date_rows",
]

def profile_sums() -> list[Column]:
    """Aggregates over parsed or judged distinct lines, each counted with its copies.

    They add up over groups: the counts by sum, the extremes by themselves.
    """
    copies = F.col(COPIES)
    quantity, price = F.col("quantity_number"), F.col("price_number")
    finite_quantity, finite_price = numbers.is_finite(quantity), numbers.is_finite(price)
    cancels, moment = F.col("cancels"), F.col("invoiced_at")
    valid_quantity = F.when(finite_quantity, quantity)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0)).cast("bigint")

    counts = {
        "rows": rows(F.lit(True)),
        "exact_duplicates_beyond_first": F.coalesce(F.sum(copies - 1), F.lit(0)).cast("bigint"),
        "c_prefixed_invoice_rows": rows(cancels),
        "negative_quantity_rows": rows(finite_quantity & (quantity < 0)),
        "negative_quantity_without_c_prefix": rows(finite_quantity & (quantity < 0) & ~cancels),
        "c_prefixed_nonnegative_quantity_rows": rows(cancels & finite_quantity & (quantity >= 0)),
        "zero_price_rows": rows(finite_price & (price == 0)),
        "negative_price_rows": rows(finite_price & (price < 0)),
        "zero_quantity_rows": rows(finite_quantity & (quantity == 0)),
        "invalid_or_nonfinite_quantity_rows": rows(~finite_quantity),
        "invalid_or_nonfinite_price_rows": rows(~finite_price),
        "nonintegral_quantity_rows": rows(finite_quantity & numbers.is_fractional(quantity)),
        "invalid_or_missing_date_rows": rows(moment.isNull()),
        **{f"missing_{name}": rows(F.col(f"missing.{name}")) for name in RAW_COLUMNS},
    }
    return [
        *[column.alias(name) for name, column in counts.items()],
        F.min(valid_quantity).alias("minimum_quantity"),
        F.max(valid_quantity).alias("maximum_quantity"),
        F.min(moment).alias("first"),
        F.max(moment).alias("last"),
    ]


def combined_profile(groups: DataFrame, column_names: list[str] = RAW_COLUMNS) -> DataFrame:
    """One row from the profile_sums of one or more groups."""
    missing = [f"missing_{name}" for name in RAW_COLUMNS]

    def summed(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)

    found = groups.agg(
        *[summed(name) for name in ["rows", *COUNTS, *missing]],
        F.min("minimum_quantity").alias("minimum_quantity"),
        F.max("maximum_quantity").alias("maximum_quantity"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    return found.select(
        "rows",
        F.lit(len(column_names)).cast("bigint").alias("columns"),
        F.array(*[F.lit(name) for name in column_names]).alias("column_names"),
        F.map_from_arrays(
            F.array(*[F.lit(name) for name in RAW_COLUMNS]), F.array(*missing)
        ).alias("missing_by_column"),
        *COUNTS,
        "minimum_quantity",
        "maximum_quantity",
        dates.iso_text(F.col("first")).alias("first_timestamp"),
        dates.iso_text(F.col("last")).alias("last_timestamp"),
    )


def raw_profile(parsed: DataFrame, column_names: list[str] = RAW_COLUMNS) -> DataFrame:
    """One row over parsed or judged distinct lines."""
    return combined_profile(parsed.agg(*profile_sums()), column_names)
