"""Control totals: what was read and what was judged, taken apart from the tables they are compared with.

Raw rows are counted by a scan of their own. Values are summed while the judged lines are written, by the
stage that writes them, whose tasks count once however often they are tried; counts taken by observing the
scan would count the rows of a lost executor's map tasks twice. The sums go by signs and prices, and so
share neither categories nor groups nor stored columns with the reports.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stallbook.functions.numbers import times_copies
from stallbook.operators.lines import COPIES, ELIGIBLE
from stallbook.schema import AUDIT_COLUMNS, MONEY, VALUE_COLUMNS
from stallbook.storage import written, written_in_shares

RAW_ROWS = "raw_rows"
CONTROL_COLUMNS = [RAW_ROWS, *AUDIT_COLUMNS, *VALUE_COLUMNS]


def _sum(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value).cast(MONEY), F.lit(0).cast(MONEY)).alias(name)


def audited() -> list[Column]:
    """Values of all raw rows by the sign of their price, and the rows that have none."""
    price, value = F.col("price_number"), times_copies(F.col("signed_value"), F.col(COPIES))
    without = F.when(F.col("signed_value").isNull(), F.col(COPIES))
    sums = (F.when(price > 0, value), F.when(price <= 0, value), without)
    return [_sum(each, name) for each, name in zip(sums, AUDIT_COLUMNS)]


def counted() -> list[Column]:
    """Sales, cancellations, other negatives and net value of the eligible lines, by signs."""
    value = F.when(F.col("disposition") == ELIGIBLE, F.col("signed_value"))
    sold = F.col("quantity_number") > 0
    sums = (F.when(sold, value), F.when(~sold & F.col("cancels"), -value), F.when(~sold & ~F.col("cancels"), -value), value)
    return [_sum(each, name) for each, name in zip(sums, VALUE_COLUMNS)]


def _added(totals: list[dict[str, Decimal]]) -> dict[str, Decimal]:
    """The totals of all shares, exact to the last of the 38 digits of MONEY."""
    with localcontext(prec=60):
        return {name: sum((each[name] for each in totals), Decimal(0)) for name in totals[0]}


def written_with_totals(shares: list[DataFrame], name: str, totals: list[Column]) -> tuple[DataFrame, dict[str, Decimal]]:
    """The shares of some lines, written by disposition, and the totals over all that the writing tasks took."""
    seen = [Observation(f"{name} totals {number}") for number in range(len(shares))]
    watched = (share.observe(each, *totals) for share, each in zip(shares, seen))
    stored = written_in_shares(watched, name, by="disposition")
    return stored, _added([each.get for each in seen])


def controls(raw: DataFrame, totals: dict[str, Decimal]) -> DataFrame:
    """One row of all control totals."""
    rows = raw.agg(F.count(F.lit(1)).alias(RAW_ROWS))
    return written(
        rows.select(RAW_ROWS, *[F.lit(totals[name]).cast(MONEY).alias(name) for name in CONTROL_COLUMNS[1:]]), "controls"
    )
