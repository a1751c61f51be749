"""Small ledgers whose totals are added up here in plain Python."""

from decimal import Decimal

import pytest
from conftest import line

from stallbook.operators import summaries
from stallbook.operators.metrics import metrics
from stallbook.plans.analysis import build_analysis
from stallbook.schema import Settings

# (invoice, stock code, quantity, price, day, customer)
TRADES = [
    ("1", "CUP", 10, "0.85", "2011-03-01 09:00:00", "11"),
    ("2", "CUP", 2, "0.95", "2011-03-30 17:45:00", "12"),
    ("3", "JUG", 1, "14.2", "2011-04-02 08:10:00", None),
    ("C4", "JUG", -1, "14.2", "2011-04-09 12:00:00", "12"),
    ("5", "CUP", -3, "0.85", "2011-12-05 11:30:00", "11"),
]

# The names of the published tables.
NAMES = {
    "overall_summary.csv",
    "product_summary.csv",
    "country_summary.csv",
    "monthly_summary.csv",
    "customer_summary.csv",
    "duplicate_comparison.csv",
    "excluded_entries.csv",
    "cleaning_summary.csv",
    "large_value_lines.csv",
}


def trade(invoice, code, quantity, price, day, customer):
    return line(
        InvoiceNo=invoice, StockCode=code, Quantity=str(quantity), UnitPrice=price, InvoiceDate=day,
        CustomerID=customer,
    )


LINES = [trade(*values) for values in TRADES]


def totals(trades):
    """Sales, cancellations, other negatives and net of some trades."""
    sales = cancelled = others = Decimal(0)
    for invoice, _, quantity, price, _, _ in trades:
        value = quantity * Decimal(price)
        if quantity > 0:
            sales += value
        elif invoice.startswith("C"):
            cancelled -= value
        else:
            others -= value
    return sales, cancelled, others, sales - cancelled - others


def found(row):
    return (
        row.positive_sales_gbp, row.cancellation_value_gbp, row.other_negative_value_gbp, row.net_value_gbp,
    )


def test_overall_metrics(eligible):
    row = metrics(eligible(*LINES)).first()
    assert found(row) == totals(TRADES)
    assert row.cancellation_value_rate_pct == pytest.approx(float(100 * totals(TRADES)[1] / totals(TRADES)[0]))


@pytest.mark.parametrize("partial", [(), ("2011-03",), ("2011-04", "2011-12")])
def test_months_have_their_own_lines_and_observed_bounds(eligible, partial):
    months = summaries.monthly_summary(eligible(*LINES), Settings(partial_months=partial)).collect()
    assert [row.Month for row in months] == ["2011-03", "2011-04", "2011-12"]
    for row in months:
        own = [values for values in TRADES if values[4].startswith(row.Month)]
        assert found(row) == totals(own)
        assert str(row.coverage_start) == min(values[4] for values in own)
        assert str(row.coverage_end) == max(values[4] for values in own)
        assert row.is_partial_month is (row.Month in partial)


@pytest.mark.parametrize("extra", [0, 1, 3])
def test_the_comparison_counts_extra_copies(cleaned, extra):
    copies = [TRADES[0]] * extra
    tables = build_analysis(cleaned(*LINES, *[trade(*values) for values in copies]))
    assert set(tables) == NAMES
    rows = {row.metric: row for row in tables["duplicate_comparison.csv"].collect()}
    before, after = totals(TRADES + copies), totals(TRADES)
    for name, old, new in (
        ("positive_sales_gbp", before[0], after[0]),
        ("net_value_gbp", before[3], after[3]),
    ):
        row = rows[name]
        assert (row.before_gbp, row.after_gbp, row.change_gbp) == (old, new, new - old)
        assert row.percentage_change == pytest.approx(float(100 * (new - old) / old))
    overall = tables["overall_summary.csv"].first()
    assert overall.eligible_row_count == len(TRADES)
    assert found(overall) == after
    known = sum(q * Decimal(p) for _, _, q, p, _, buyer in TRADES if q > 0 and buyer)
    assert overall.identified_positive_sales_gbp == known


def test_a_ledger_without_eligible_lines_is_refused(cleaned):
    worthless = [line(Quantity="0"), line(StockCode="POST"), line(InvoiceDate="never")]
    with pytest.raises(ValueError, match="No eligible merchandise"):
        build_analysis(cleaned(*worthless))
