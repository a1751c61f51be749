"""Every operator as a query over a folder of order tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.functions import dates, numbers, text
from stallbook.operators import audit, summaries
from stallbook.operators.lines import (
    classified_lines,
    distinct_lines,
    eligible_lines,
    every_copy,
    for_lines,
    judge,
    parsed_lines,
    stored_lines,
    with_copy_key,
)
from stallbook.operators.metrics import category_counts, metrics, metrics_by
from stallbook.operators.profile import raw_profile
from stallbook.operators.sensitivity import duplicate_comparison, with_every_copy
from stallbook.plans import chartdata
from stallbook.plans.analysis import audit_and_profile, build_tables, clean, compare_controls, reconcile
from stallbook.plans.publish import export_columns, run_metadata
from stallbook.schema import RAW_COLUMNS, Settings
from stallbook.sources.files import RawLedger, read_ledger
from stallbook.sources.fingerprint import changed_files, fingerprint, ordered_digest
from stallbook.sources.numbering import number_parquet_rows
from stallbook.sources.order_lines import raw_order_lines, raw_order_shares
from stallbook.storage import shared_folder, written, written_in_shares

Query = Callable[[SparkSession, str], DataFrame]

# The derived lines end in August 2001, a month of one day.
SETTINGS = Settings(partial_months=("2001-08",), home_country="NATION_0")

MONTH_INPUTS = ["Month", "InvoiceDate", "signed_value_gbp", "transaction_category"]

REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a function under its name; a closing _query only avoids name clashes."""
    REGISTERED[function.__name__.removesuffix("_query")] = function
    return function


def portable(df: DataFrame) -> DataFrame:
    """Types every SQL engine shares: money as double, time stamps as text."""

    def form(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            return dates.second(column).alias(field.name)
        return column

    return df.select(*[form(field) for field in df.schema.fields])


def _raw(spark, folder, numbered=False):
    return raw_order_lines(spark, folder, numbered)


def _judged(spark, folder, numbered=False):
    return judge(_raw(spark, folder, numbered))


def _lines(spark, folder, numbered=False):
    return classified_lines(_judged(spark, folder, numbered))


def _raw_once(spark, folder):
    """Numbered raw lines, written in shares, for queries that read them more than once: deriving them takes three joins."""
    return written_in_shares(raw_order_shares(spark, folder), "raw")


def _every_line(spark, folder, numbered=False):
    """Judged lines with duplicates kept: each copy is a line of its own, under the judgement of the first."""
    raw = _raw_once(spark, folder) if numbered else _raw(spark, folder)
    return every_copy(stored_lines(for_lines(with_copy_key(judge(raw)))), raw)


# --- sources and scalar functions, on every raw line


@query
def raw_lines(spark, folder):
    return _raw(spark, folder, numbered=True)


@query
def source_fingerprint(spark, folder):
    return fingerprint(spark, f"{folder}/lineitem.parquet")


@query
def input_unchanged(spark, folder):
    """Every ledger input, and whether a second fingerprint found it changed."""
    paths = f"{folder}/{{lineitem,orders,customer,nation,part}}.parquet"
    before = fingerprint(spark, paths)
    changed = changed_files(before, fingerprint(spark, paths))
    return before.join(changed, "path", "left").select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.coalesce("digest_before", "digest_after").isNull().alias("unchanged"),
    )


@query
def csv_source(spark, folder):
    """The raw lines as a folder of CSV files gives them back, recognised by its files."""
    path = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _raw(spark, folder).write.options(header=True, escape='"', **blanks).csv(path)
    return read_ledger(spark, path).lines.select(*RAW_COLUMNS)


@query
def typed_source(spark, folder):
    """Lines of typed Parquet columns as text: whole numbers, dates and instants of a declared zone."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    moment = F.timestamp_seconds(F.col("l_orderkey") * 86_400 + F.col("l_linenumber") * 3_600)
    typed = written(
        lines.select(
            F.col("l_orderkey").alias("InvoiceNo"),
            F.col("l_partkey").cast("double").alias("StockCode"),
            F.col("l_returnflag").alias("Description"),
            F.col("l_quantity").alias("Quantity"),
            moment.alias("InvoiceDate"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("UnitPrice"),
            F.col("l_suppkey").cast("int").alias("CustomerID"),
            F.col("l_linestatus").alias("Country"),
        ),
        "typed",
    )
    return read_ledger(spark, typed.inputFiles()[0].rsplit("/", 1)[0], form="parquet", time_zone="Asia/Kolkata").lines.select(*RAW_COLUMNS)


@query
def content_digests(spark, folder):
    """Digest of each thousand raw lines as they are, and with every two neighbours swapped."""
    lines = _raw(spark, folder, numbered=True)
    content = F.concat_ws("|", *[F.coalesce(F.col(name), F.lit("-")) for name in RAW_COLUMNS])
    place, block = F.col("source_row"), F.floor(F.col("source_row") / 1000).alias("block")
    swapped = ordered_digest(lines, place.bitwiseXOR(F.lit(1)), content, block)
    return ordered_digest(lines, place, content, block).join(
        swapped.select("block", F.col("digest").alias("digest_of_swapped")), "block"
    )


@query
def source_rows(spark, folder):
    """Row numbers of a Parquet source, as any reader of one gets them."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return number_parquet_rows(lines).select(
        "source_row", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )


@query
def numeric_identifiers(spark, folder):
    """Numeric source columns as text: whole numbers without a fraction."""
    lines = number_parquet_rows(spark.read.parquet(f"{folder}/lineitem.parquet"))
    price = F.col("l_extendedprice")
    return lines.select(
        "source_row",
        text.number_as_identifier(F.col("l_quantity")).alias("quantity_text"),
        F.when(price % 1 == 0, text.number_as_identifier(price)).alias("whole_price_text"),
    )


@query
def fractional_identifiers(spark, folder):
    """Numeric source columns that are no whole numbers, as text."""
    lines = number_parquet_rows(spark.read.parquet(f"{folder}/lineitem.parquet"))
    price = F.col("l_extendedprice")
    return lines.where(price % 1 != 0).select(
        "source_row", text.number_as_identifier(price).alias("fractional_price_text")
    )


@query
def parsed_numbers(spark, folder):
    lines = _raw(spark, folder, numbered=True)
    quantity, price = numbers.number(F.col("Quantity")), numbers.number(F.col("UnitPrice"))
    parsed = lines.select("source_row", quantity.alias("quantity"), price.alias("price"))
    finite_quantity = numbers.is_finite(F.col("quantity"))
    finite_price = numbers.is_finite(F.col("price"))
    return parsed.select(
        "source_row",
        # Infinite values compare badly across engines, so they show as not finite.
        F.when(finite_quantity, F.col("quantity")).alias("quantity"),
        F.when(finite_price, F.col("price")).alias("price"),
        finite_quantity.alias("finite_quantity"),
        finite_price.alias("finite_price"),
        (finite_quantity & finite_price).alias("computable"),
        numbers.is_fractional(F.when(finite_quantity, F.col("quantity"))).alias("fractional"),
    )


@query
def cancellation_flag(spark, folder):
    return _raw(spark, folder, numbered=True).select(
        "source_row", text.is_cancellation(F.col("InvoiceNo")).alias("is_cancellation")
    )


@query
def normalized_identifiers(spark, folder):
    return _raw(spark, folder, numbered=True).select(
        "source_row",
        text.identifier(F.col("InvoiceNo")).alias("invoice_no"),
        text.identifier(F.col("StockCode")).alias("stock_code"),
        text.description(F.col("Description")).alias("description"),
        text.customer(F.col("CustomerID")).alias("customer_id"),
        text.country(F.col("Country")).alias("country"),
    )


@query
def parsed_dates(spark, folder):
    return (
        _raw(spark, folder, numbered=True)
        .select("source_row", dates.timestamp(F.col("InvoiceDate")).alias("moment"))
        .select(
            "source_row",
            dates.second(F.col("moment")).alias("invoice_date"),
            dates.month(F.col("moment")).alias("month"),
        )
    )


@query
def signed_values(spark, folder):
    lines = parsed_lines(_raw(spark, folder, numbered=True))
    return portable(
        lines.select(
            "source_row",
            F.col("signed_value").alias("signed_value_gbp"),
            F.abs("signed_value").alias("absolute_value_gbp"),
        )
    )


@query
def price_status(spark, folder):
    lines = parsed_lines(_raw(spark, folder, numbered=True))
    status = numbers.price_status(F.col("computable"), F.col("price_number"))
    return lines.select("source_row", status.alias("price_status"))


# --- deduplication, rules and eligible lines


@query
def dedup_lines(spark, folder):
    return distinct_lines(_raw(spark, folder, numbered=True))


@query
def line_disposition(spark, folder):
    return _judged(spark, folder, numbered=True).select(
        "source_row", "copies", "disposition"
    )


@query
def eligible_lines_query(spark, folder):
    return portable(eligible_lines(stored_lines(for_lines(_judged(spark, folder, numbered=True)))))


@query
def category_counts_query(spark, folder):
    return category_counts(_lines(spark, folder))


@query
def excluded_lines_semi(spark, folder):
    return audit.excluded_lines(_judged(spark, folder, numbered=True)).select(
        "source_row", F.col("code").alias("stock_code")
    )


@query
def non_excluded_lines_anti(spark, folder):
    return audit.merchandise_lines(_judged(spark, folder, numbered=True)).select(
        "source_row", F.col("code").alias("stock_code")
    )


# --- metrics and summary tables


@query
def overall_metrics(spark, folder):
    return portable(metrics(_lines(spark, folder)))


@query
def metrics_by_key(spark, folder):
    """Grouped metrics on a key with nulls: unknown customers are a group too."""
    return portable(metrics_by(_lines(spark, folder), "CustomerID"))


@query
def product_summary(spark, folder):
    return portable(summaries.product_summary(_lines(spark, folder)))


@query
def product_summary_distributed(spark, folder):
    """The same table ranked in so many ranges that equal values lie in several."""
    return portable(summaries.product_summary(_lines(spark, folder), ranges=64))


@query
def description_frequency(spark, folder):
    return summaries.description_frequency(_lines(spark, folder))


@query
def country_summary(spark, folder):
    return portable(summaries.country_summary(_lines(spark, folder)))


@query
def monthly_summary(spark, folder):
    return portable(summaries.monthly_summary(_lines(spark, folder), SETTINGS))


@query
def month_coverage_join(spark, folder):
    """Month metrics with the coverage joined to them, both from one written table."""
    lines = written(summaries.with_month(_lines(spark, folder)).select(*MONTH_INPUTS), "months")
    by_month = metrics_by(lines, "Month")
    return portable(by_month.join(summaries.month_coverage(lines), "Month", "left"))


@query
def customer_summary(spark, folder):
    return portable(summaries.customer_summary(_lines(spark, folder)))


@query
def customer_summary_distributed(spark, folder):
    """The same table ordered in many ranges."""
    return portable(summaries.customer_summary(_lines(spark, folder), ranges=64))


@query
def customer_statistics(spark, folder):
    return portable(summaries.customer_statistics(_lines(spark, folder)))


@query
def overall_summary(spark, folder):
    return portable(summaries.overall_summary(_lines(spark, folder)))


@query
def top_products(spark, folder):
    products = summaries.product_totals(_lines(spark, folder))
    return portable(summaries.top_products(products))


@query
def top_countries(spark, folder):
    """The best ten countries without the home country."""
    countries = metrics_by(_lines(spark, folder), "Country")
    return portable(summaries.top_countries(countries, without=SETTINGS.home_country))


@query
def large_value_lines(spark, folder):
    return portable(summaries.large_value_lines(_lines(spark, folder, numbered=True)))


# --- audit, exclusions and profile


@query
def audit_values(spark, folder):
    """Audit values of all raw rows, copies included."""
    return portable(audit.audit_values(_judged(spark, folder), F.col("copies")))


@query
def stage_audit(spark, folder):
    return portable(audit.stage_audit(audit.audit_by_disposition(_judged(spark, folder))))


@query
def stage_audit_without_dedup(spark, folder):
    charged = audit.audit_by_disposition(_judged(spark, folder), remove_duplicates=False)
    return portable(audit.stage_audit(charged))


@query
def eligible_total(spark, folder):
    return portable(audit.eligible_total(audit.audit_by_disposition(_judged(spark, folder))))


@query
def excluded_entries(spark, folder):
    return portable(audit.excluded_entries(_judged(spark, folder)))


@query
def excluded_entries_raw_basis(spark, folder):
    return portable(audit.excluded_entries(_judged(spark, folder), remove_duplicates=False))


@query
def raw_profile_query(spark, folder):
    profile = raw_profile(parsed_lines(distinct_lines(_raw(spark, folder))))
    missing = [
        F.col("missing_by_column")[name].alias(f"missing_{name}") for name in RAW_COLUMNS
    ]
    return profile.select(
        "*",
        *missing,
        F.array_join("column_names", ",").alias("names"),
    ).drop("missing_by_column", "column_names")


@query
def cleaning_summary(spark, folder):
    charged, profile = audit_and_profile(_judged(spark, folder))
    return portable(audit.cleaning_summary(charged, profile).drop("seq"))


# --- scenario and reconciliation


@query
def duplicate_comparison_query(spark, folder):
    return portable(duplicate_comparison(_lines(spark, folder)))


@query
def metrics_with_duplicates(spark, folder):
    """Overall metrics as if duplicates had been kept."""
    return portable(metrics(with_every_copy(_lines(spark, folder))))


@query
def eligible_lines_without_dedup(spark, folder):
    return portable(eligible_lines(_every_line(spark, folder, numbered=True)))


@query
def overall_summary_without_dedup(spark, folder):
    return portable(summaries.overall_summary(classified_lines(_every_line(spark, folder))))


@query
def product_summary_without_dedup(spark, folder):
    return portable(summaries.product_summary(classified_lines(_every_line(spark, folder))))


@query
def reconciliation(spark, folder):
    """All checks of a whole run, each with both totals."""
    cleaned = clean(RawLedger(_raw(spark, folder, numbered=True), RAW_COLUMNS))
    return portable(reconcile(cleaned, build_tables(cleaned, SETTINGS)))


@query
def control_totals(spark, folder):
    """What the rules were charged with and the tables, each beside its control total."""
    cleaned = clean(RawLedger(_raw_once(spark, folder), RAW_COLUMNS, stored=True))
    return portable(compare_controls(cleaned, build_tables(cleaned, SETTINGS)))


# --- chart data


@query
def chart_products(spark, folder):
    products = summaries.product_totals(_lines(spark, folder))
    return portable(chartdata.chart_products(products))


@query
def chart_countries(spark, folder):
    countries = written(metrics_by(_lines(spark, folder), "Country"), "countries")
    return portable(chartdata.chart_countries(countries, SETTINGS))


@query
def chart_months(spark, folder):
    months = summaries.monthly_summary(_lines(spark, folder), SETTINGS)
    return portable(chartdata.chart_months(months))


@query
def chart_net_steps(spark, folder):
    return portable(chartdata.chart_net_steps(metrics(_lines(spark, folder))))


@query
def chart_period(spark, folder):
    return chartdata.chart_period(_lines(spark, folder).agg(*summaries.coverage()))


# --- sinks


@query
def export_rounding(spark, folder):
    """The country table as published: two decimals."""
    countries = summaries.country_summary(_lines(spark, folder))
    return portable(countries.select(*export_columns(countries)))


@query
def run_metadata_query(spark, folder):
    files = written(fingerprint(spark, f"{folder}/lineitem.parquet"), "fingerprint")
    judged = _judged(spark, folder)
    profile = written(raw_profile(judged), "profile")
    return run_metadata(f"{folder}/lineitem.parquet", "out", ["overall_summary.csv"], files, profile)
