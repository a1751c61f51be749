"""What the charts show, as small tables; drawing them is not done here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.functions import dates
from stallbook.operators.summaries import top_countries, top_products
from stallbook.schema import Settings

# The names under which the charts show their data.
SALES_SERIES = "Positive sales (S)"
NET_SERIES = "Net recorded value (N)"
ALL_COUNTRIES = "Top 10 — all countries"
WITHOUT_HOME = "Top 10 — excluding "
NET_STEPS = [
    ("Positive sales S", "positive_sales_gbp", 1),
    ("Cancellation deduction −C", "cancellation_value_gbp", -1),
    ("Other-negative deduction −A", "other_negative_value_gbp", -1),
    ("Net recorded value N", "net_value_gbp", 1),
]


def chart_products(products: DataFrame, limit: int = 10) -> DataFrame:
    return top_products(products, limit).select(
        F.concat_ws(" — ", "StockCode", "Description").alias("label"), "positive_sales_gbp"
    )


def chart_countries(countries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Two panels: all countries, and all but the home country."""

    def panel(title: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(title).alias("panel"), "Country", "positive_sales_gbp")

    everywhere = top_countries(countries, settings.top)
    abroad = top_countries(countries, settings.top, without=settings.home_country)
    return panel(ALL_COUNTRIES, everywhere).unionByName(
        panel(WITHOUT_HOME + settings.home_country, abroad)
    )


def chart_months(months: DataFrame) -> DataFrame:
    """Two series by month. A link is to the month before; the first has none.

    The window orders calendar months, of which there are twelve a year.
    """
    previous = F.lag("is_partial_month").over(Window.orderBy("Month"))
    link = F.when(previous.isNotNull(), F.col("is_partial_month") | previous)
    return (
        months.withColumn("link_is_partial", link)
        .withColumnsRenamed({"positive_sales_gbp": SALES_SERIES, "net_value_gbp": NET_SERIES})
        .unpivot(
            ["Month", "is_partial_month", "link_is_partial"],
            [SALES_SERIES, NET_SERIES],
            "series",
            "value_gbp",
        )
    )


def chart_net_steps(overall: DataFrame) -> DataFrame:
    """S, -C, -A and N in order."""
    steps = [
        F.struct(
            F.lit(number).alias("step_no"),
            F.lit(label).alias("step"),
            (F.col(name) if sign > 0 else -F.col(name)).alias("value_gbp"),
        )
        for number, (label, name, sign) in enumerate(NET_STEPS, 1)
    ]
    return overall.select(F.explode(F.array(*steps)).alias("entry")).select("entry.*")


def period_label() -> Column:
    return F.concat(
        dates.day(F.col("coverage_start")),
        F.lit(" to "),
        dates.day(F.col("coverage_end")),
        F.lit(" | Eligible deduplicated merchandise"),
    )


def chart_period(overall: DataFrame) -> DataFrame:
    return overall.select(period_label().alias("period"))
