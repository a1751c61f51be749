"""Publishing: CSV directories, the eligible lines and the run metadata."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions import dates
from stallbook.operators.checks import ABSOLUTE_TOLERANCE, RELATIVE_TOLERANCE
from stallbook.schema import EXCLUDED_CODES, RAW_COLUMNS, Settings

# Tables whose row number does not depend on the data; they become one file.
FIXED_SIZE = {
    "overall_summary.csv",
    "duplicate_comparison.csv",
    "excluded_entries.csv",
    "cleaning_summary.csv",
    "large_value_lines.csv",
}

# The order in which each table is published.
PUBLISHED_ORDER = {
    "product_summary.csv": [F.desc, "positive_sales_gbp", "StockCode"],
    "country_summary.csv": [F.desc, "positive_sales_gbp", "Country"],
    "monthly_summary.csv": [F.asc, "Month"],
    "customer_summary.csv": [F.asc, "display_order"],
    "excluded_entries.csv": [F.asc, "StockCode"],
    "cleaning_summary.csv": [F.asc, "seq"],
}

# The nine tables.
TABLES = (
    "overall_summary.csv",
    "product_summary.csv",
    "country_summary.csv",
    "monthly_summary.csv",
    "customer_summary.csv",
    "duplicate_comparison.csv",
    "excluded_entries.csv",
    "cleaning_summary.csv",
    "large_value_lines.csv",
)

# The keys under which a run says how its numbers are made.
CURRENCY, NET_VALUE, PARTIAL_MONTHS = "currency", "net_value_definition", "partial_month_policy"
MONTH_TIMES, DUPLICATES, BASIS, EXPORT = (
    "monthly_timestamp_definition", "duplicate_policy", "excluded_entries_basis", "export_policy",
)


def policies(settings: Settings) -> dict[str, str]:
    """What this engine does, by key."""
    codes = len(EXCLUDED_CODES)
    months = ", ".join(settings.partial_months) or "no month"
    return {
        CURRENCY: "GBP",
        NET_VALUE: f"positive_sales_gbp - cancellation_value_gbp - other_negative_value_gbp; the {codes} excluded codes are left out.",
        PARTIAL_MONTHS: f"is_partial_month is true for {months}, as set by Settings.partial_months, and never inferred from the lines.",
        MONTH_TIMES: "min and max of InvoiceDate over the eligible lines of the month.",
        DUPLICATES: "Grouped by " + ", ".join(RAW_COLUMNS) + " as read; a group is one line with the least source_row.",
        BASIS: "post_deduplication",
        EXPORT: "_gbp, _pct: decimal(38,2), rounded half up from exact values; UnitPrice: as in the source; null: empty.",
    }


def is_two_decimal(name: str) -> bool:
    return name.endswith(("_gbp", "_pct")) or name == "percentage_change"


def is_integer(name: str) -> bool:
    return name.endswith(("_rows", "_count", "_rank")) or name in (
        "source_row",
        "display_order",
        "Quantity",
    )


def two_decimals(value: Column) -> Column:
    """Two decimals, null where unavailable; a decimal has no negative zero."""
    return value.cast("decimal(38,2)")


def plain_number(value: Column) -> Column:
    """A decimal as text without padding: 649.5, 10.0, 0.001."""
    text = F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1")
    return F.regexp_replace(text, r"\.$", ".0")


def export_columns(df: DataFrame) -> list[Column]:
    """Every column in its published form; calculations keep their own precision."""

    def form(field: T.StructField) -> Column:
        name, column = field.name, F.col(field.name)
        if is_two_decimal(name):
            return two_decimals(column).alias(name)
        if is_integer(name):
            return column.cast("bigint").alias(name)
        if name == "UnitPrice":
            return plain_number(column).alias(name)
        if isinstance(field.dataType, T.BooleanType):
            return F.initcap(column.cast("string")).alias(name)
        if isinstance(field.dataType, T.TimestampNTZType):
            return dates.second(column).alias(name)
        return column

    return [form(field) for field in df.schema.fields]


def in_published_order(name: str, table: DataFrame) -> DataFrame:
    if name == "large_value_lines.csv":
        return table.orderBy(F.desc("absolute_line_value_gbp"), "source_row")
    if name not in PUBLISHED_ORDER:
        return table
    direction, first, *others = PUBLISHED_ORDER[name]
    return table.orderBy(direction(first), *others)


def export_table(name: str, table: DataFrame, folder: str) -> None:
    """Write one table as a directory of CSV files, in order, replacing the old one."""
    ordered = in_published_order(name, table)
    exported = ordered.select(*export_columns(ordered)).drop("seq")
    if name in FIXED_SIZE:
        exported = exported.coalesce(1)
    (
        exported.write.mode("overwrite")
        .options(
            header=True,
            escape='"',
            emptyValue="",
            nullValue="",
            lineSep="\n",
            encoding="UTF-8",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(f"{folder}/{name}")
    )


def export_json(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def run_metadata(
    source: str,
    folder: str,
    outputs: list[str],
    fingerprint: DataFrame,
    profile: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row describing a run, from the written fingerprint and the one-row profile."""
    spark = profile.sparkSession
    files = fingerprint.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        # Only a single file has one digest; of more, all are listed in input_files.
        F.when(
            (F.count(F.lit(1)) == 1) & F.bool_and("of_content"), F.max("sha256")
        ).alias("sha256"),
        F.when(F.count(F.lit(1)) == 1, F.max("content_digest")).alias("content_digest"),
    )
    described = files.select(
        F.lit(datetime.now(timezone.utc).isoformat()).alias("run_timestamp_utc"),
        F.lit(source.rstrip("/").rsplit("/", 1)[-1]).alias("input_filename"),
        F.col("sha256").alias("input_sha256"),
        F.col("content_digest").alias("input_content_digest"),
        F.col("files").alias("input_files"),
        F.col("bytes").alias("input_bytes"),
        F.lit(spark.version).alias("spark_version"),
        F.create_map(
            *[part for name in outputs for part in (F.lit(name), F.lit(f"{folder}/{name}"))]
        ).alias("output_paths"),
        *[F.lit(text).alias(name) for name, text in policies(settings).items()],
        F.struct(
            F.lit(ABSOLUTE_TOLERANCE).alias("absolute_gbp"),
            F.lit(RELATIVE_TOLERANCE).alias("relative"),
        ).alias("monetary_reconciliation_tolerance"),
    )
    whole_profile = profile.select(F.struct("*").alias("raw_profile")).scalar()
    return described.withColumn("raw_profile", whole_profile)
