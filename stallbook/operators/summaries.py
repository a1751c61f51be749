"""The summary tables of classified lines, of which only eligible ones count.

Each table exists as a function of lines and as a function of totals, which are the
lines added up at any grain that has the table's key. A run adds the lines up by
country and month once and takes four of its tables from that small result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import dates
from stallbook.functions.rates import percentage
from stallbook.operators.lines import is_eligible
from stallbook.operators.metrics import (
    RATE,
    net,
    of_category,
    resums,
    sums_by,
    total,
    with_derived,
)
from stallbook.operators.ranking import with_descending_ranks, with_positions
from stallbook.operators.sensitivity import sums_before
from stallbook.schema import MONEY, POSITIVE_SALE, VALUE_COLUMNS, Settings
from stallbook.storage import written

PRODUCT_COLUMNS = [
    "StockCode",
    "Description",
    *VALUE_COLUMNS,
    RATE,
    "sales_share_pct",
    "positive_sales_rank",
    "net_value_rank",
]
COUNTRY_COLUMNS = ["Country", *VALUE_COLUMNS, RATE, "sales_share_pct"]
MONTH_COLUMNS = [
    "Month", *VALUE_COLUMNS, RATE, "coverage_start", "coverage_end", "is_partial_month",
]
CUSTOMER_COLUMNS = [
    "CustomerID",
    "positive_sales_gbp",
    "share_of_identified_sales_pct",
    "display_order",
    "is_top_10",
]
STATISTICS_COLUMNS = [
    "identified_positive_sales_gbp",
    "unidentified_positive_sales_gbp",
    "identified_sales_coverage_pct",
    "top_10_customer_sales_gbp",
    "top_10_customer_concentration_pct",
    "identified_positive_customer_count",
]
OVERALL_COLUMNS = [
    *VALUE_COLUMNS,
    RATE,
    "eligible_row_count",
    "coverage_start",
    "coverage_end",
    *STATISTICS_COLUMNS,
]
LARGE_LINE_COLUMNS = [
    "source_row",
    "InvoiceNo",
    "StockCode",
    "Description",
    "InvoiceDate",
    "Quantity",
    "UnitPrice",
    "transaction_category",
    "signed_value_gbp",
    "absolute_line_value_gbp",
]


def _sales_first(key: str) -> list:
    return [F.col("positive_sales_gbp").desc(), F.col(key).asc()]


def _share(table: DataFrame, whole: DataFrame, name: str) -> DataFrame:
    """Each group's share of all sales; whole must be written, as it is read once more."""
    sales = whole.agg(total(F.col("positive_sales_gbp")).alias("sales")).scalar()
    return table.withColumn(name, percentage(F.col("positive_sales_gbp"), sales))


def country_month_totals(lines: DataFrame) -> DataFrame:
    """What the overall, country and month tables and the duplicate comparison need."""
    return sums_by(
        with_month(lines), "Country", "Month", extra=[*coverage(), *sums_before()]
    )


def description_frequency(lines: DataFrame) -> DataFrame:
    """Lines of each product that carry each label; blank labels do not count."""
    return (
        lines.groupBy("StockCode", "Description")
        .agg(F.count("transaction_category").alias("row_count"))
        .where((F.col("row_count") > 0) & (F.col("Description") != ""))
    )


def product_totals(lines: DataFrame) -> DataFrame:
    """S, C, A and the display label of each product.

    Lines are first added up by product and label, which any product's lines share
    out evenly; the label is then the most frequent one, the first in the alphabet
    among equals, and the code itself where all are blank.
    """
    by_label = sums_by(lines, "StockCode", "Description")
    named = F.when(
        F.col("Description") != "", F.struct(-F.col("lines"), F.col("Description").alias("label"))
    )
    return (
        by_label.groupBy("StockCode")
        .agg(F.min(named).alias("best"), *resums())
        .select(
            "StockCode",
            F.coalesce("best.label", "StockCode").alias("Description"),
            "positive_sales_gbp",
            "cancellation_value_gbp",
            "other_negative_value_gbp",
            net().alias("net_value_gbp"),
        )
    )


def product_summary(lines: DataFrame, ranges: int | None = None) -> DataFrame:
    products = written(product_totals(lines), "products")
    ranked = with_descending_ranks(
        products,
        {"positive_sales_gbp": "positive_sales_rank", "net_value_gbp": "net_value_rank"},
        "StockCode",
        ranges,
    )
    return (
        _share(with_derived(ranked), products, "sales_share_pct")
        .select(*PRODUCT_COLUMNS)
        .orderBy(*_sales_first("StockCode"))
    )


def top_products(products: DataFrame, limit: int = 10) -> DataFrame:
    """Products with sales, best first; fewer than limit if there are fewer."""
    return (
        products.where(F.col("positive_sales_gbp") > 0)
        .orderBy(*_sales_first("StockCode"))
        .limit(limit)
    )


def country_table(totals: DataFrame) -> DataFrame:
    countries = with_derived(totals.groupBy("Country").agg(*resums()))
    return (
        _share(countries, totals, "sales_share_pct")
        .select(*COUNTRY_COLUMNS)
        .orderBy(*_sales_first("Country"))
    )


def country_summary(lines: DataFrame) -> DataFrame:
    return country_table(written(sums_by(lines, "Country"), "countries"))


def top_countries(
    countries: DataFrame, limit: int = 10, without: str | None = None
) -> DataFrame:
    """Countries with sales, best first, optionally without the home country."""
    chosen = countries.where(F.col("positive_sales_gbp") > 0)
    if without is not None:
        chosen = chosen.where(F.col("Country") != without)
    return chosen.orderBy(*_sales_first("Country")).limit(limit)


def with_month(lines: DataFrame) -> DataFrame:
    return lines.withColumn("Month", dates.month(F.col("InvoiceDate")))


def coverage() -> list[Column]:
    """First and last eligible time stamp."""
    observed = F.when(is_eligible(), F.col("InvoiceDate"))
    return [F.min(observed).alias("coverage_start"), F.max(observed).alias("coverage_end")]


def covered() -> list[Column]:
    """First and last time stamp of groups of totals."""
    return [
        F.min("coverage_start").alias("coverage_start"),
        F.max("coverage_end").alias("coverage_end"),
    ]


def month_coverage(lines: DataFrame) -> DataFrame:
    """First and last eligible time stamp of each Month; see with_month."""
    return (
        lines.groupBy("Month")
        .agg(*coverage())
        .where(F.col("coverage_start").isNotNull())
    )


def month_table(totals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return (
        with_derived(totals.groupBy("Month").agg(*resums(), *covered()))
        .withColumn("is_partial_month", F.col("Month").isin(list(settings.partial_months)))
        .select(*MONTH_COLUMNS)
        .orderBy("Month")
    )


def monthly_summary(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return month_table(sums_by(with_month(lines), "Month", extra=coverage()), settings)


def customer_totals(lines: DataFrame) -> DataFrame:
    """Positive sales of each customer who has any; unknown customers are one row."""
    return (
        lines.groupBy("CustomerID")
        .agg(total(of_category(POSITIVE_SALE)).alias("positive_sales_gbp"))
        .where(F.col("positive_sales_gbp") > 0)
    )


def customer_table(customers: DataFrame, ranges: int | None = None) -> DataFrame:
    """Identified customers, best first, with shares of identified sales.

    customers holds one row for each customer and must be written.
    """
    known = customers.where(F.col("CustomerID").isNotNull() & (F.col("positive_sales_gbp") > 0))
    placed = with_positions(
        known.select("CustomerID", "positive_sales_gbp"),
        [("positive_sales_gbp", True), ("CustomerID", False)],
        "display_order",
        ranges,
    )
    return (
        _share(placed, known, "share_of_identified_sales_pct")
        .withColumn("is_top_10", F.col("display_order") <= 10)
        .select(*CUSTOMER_COLUMNS)
        .orderBy("display_order")
    )


def customer_summary(lines: DataFrame, ranges: int | None = None) -> DataFrame:
    return customer_table(written(customer_totals(lines), "customers"), ranges)


def customer_sums(customers: DataFrame) -> DataFrame:
    """One row: sales of identified customers, of the ten best of them, and of the others."""
    sales, known = F.col("positive_sales_gbp"), F.col("CustomerID").isNotNull()
    best = (
        customers.where(known & (sales > 0))
        .orderBy(*_sales_first("CustomerID"))
        .limit(10)
        # Null when no customer is identified, as there is then nothing to concentrate.
        .agg(F.sum(sales).cast(MONEY).alias("best"))
    )
    return customers.agg(
        total(F.when(known, sales)).alias("identified_positive_sales_gbp"),
        total(F.when(~known, sales)).alias("unidentified_positive_sales_gbp"),
        F.count_if(known & (sales > 0)).alias("identified_positive_customer_count"),
    ).withColumn("top_10_customer_sales_gbp", best.scalar())


def overall_table(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """One row: metrics, coverage and customer concentration; both must be written."""
    found = customer_sums(customers).select(F.struct("*").alias("found")).scalar()
    sales, identified = F.col("positive_sales_gbp"), F.col("identified_positive_sales_gbp")
    return (
        with_derived(
            totals.agg(
                *resums(),
                F.coalesce(F.sum("lines"), F.lit(0)).alias("eligible_row_count"),
                *covered(),
            )
        )
        .withColumn("found", found)
        .select("*", "found.*")
        .withColumn("identified_sales_coverage_pct", percentage(identified, sales))
        .withColumn(
            "top_10_customer_concentration_pct",
            percentage(F.col("top_10_customer_sales_gbp"), identified),
        )
        .select(*OVERALL_COLUMNS)
    )


def overall_summary(lines: DataFrame) -> DataFrame:
    by_customer = written(sums_by(lines, "CustomerID", extra=coverage()), "by_customer")
    return overall_table(by_customer, by_customer)


def customer_statistics(lines: DataFrame) -> DataFrame:
    return overall_summary(lines).select(*STATISTICS_COLUMNS)


def large_value_lines(lines: DataFrame, limit: int = 10) -> DataFrame:
    """The lines of largest absolute value, for review; nothing is removed."""
    absolute = F.when(is_eligible(), F.abs("signed_value_gbp"))
    return (
        lines.withColumn("absolute_line_value_gbp", absolute)
        .orderBy(F.col("absolute_line_value_gbp").desc_nulls_last(), F.col("source_row").asc())
        .limit(limit)
        # Without enough eligible lines, the limit lets removed ones through.
        .where(F.col("absolute_line_value_gbp").isNotNull())
        .select(*LARGE_LINE_COLUMNS)
    )
