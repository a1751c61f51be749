"""Control totals: each check fails when one of its sides is wrong."""

from dataclasses import replace

import pytest
from conftest import DEFAULT, line
from pyspark.sql import functions as F

from stallbook.plans.analysis import build_analysis, build_tables, compare_controls


def ledger():
    return [
        line(),
        line(),
        line(StockCode="HAT", UnitPrice="2.5", Country="Norway", InvoiceDate="2011-07-01"),
        line(InvoiceNo="C77", Quantity="-1"),
        line(InvoiceNo="78", Quantity="-2", UnitPrice="1"),
        line(StockCode="POST", UnitPrice="-4"),
        line(UnitPrice="dear"),
    ]


def failed(cleaned, tables):
    return {row.check for row in compare_controls(cleaned, tables).where("not ok").collect()}


def test_each_check_sees_a_change_of_one_side(cleaned):
    whole = cleaned(*ledger())
    tables = build_tables(whole)
    assert failed(whole, tables) == set()
    one = F.when(F.col("disposition") == "eligible", 1).otherwise(0)
    for column, check in (
        ("row_count", "charged: raw_rows"),
        ("signed_value_positive_price_gbp", "charged: signed_value_positive_price_gbp"),
        ("signed_value_nonpositive_price_gbp", "charged: signed_value_nonpositive_price_gbp"),
        ("uncomputable_value_count", "charged: uncomputable_value_count"),
    ):
        kind = whole.charged.schema[column].dataType
        wrong = replace(whole, charged=whole.charged.withColumn(column, (F.col(column) + one).cast(kind)))
        assert failed(wrong, tables) == {check}
        # A row that the scan never delivered, or delivered twice, is on the other side.
        name = check.removeprefix("charged: ")
        assert failed(replace(whole, controls=whole.controls.withColumn(name, F.col(name) - 1)), tables) == {check}
    for label, name, lost in (
        ("products", "product", "StockCode = 'HAT'"),
        ("countries", "country", "Country = 'Norway'"),
        ("months", "monthly", "Month = '2011-07'"),
        ("overall", "overall", "true"),
    ):
        file = f"{name}_summary.csv"
        missing = {**tables, file: tables[file].where(f"not ({lost})")}
        assert failed(whole, missing) >= {f"{label}: positive_sales_gbp", f"{label}: net_value_gbp"}
        assert all(check.startswith(label) for check in failed(whole, missing))


def test_a_run_fails_when_its_tables_miss_a_line(cleaned):
    whole = cleaned(*ledger())
    short = replace(whole, eligible=whole.eligible.where("StockCode <> 'HAT'"))
    with pytest.raises(ValueError, match="Reconciliation failed for (countries|months|overall|products)"):
        build_analysis(short)
    doubled = replace(whole, eligible=whole.eligible.unionByName(whole.eligible.where("StockCode = 'HAT'")))
    with pytest.raises(ValueError, match="Reconciliation failed"):
        build_analysis(doubled)


@pytest.mark.parametrize("remove_duplicates", [True, False])
def test_totals_follow_the_lines_that_count(cleaned, remove_duplicates):
    totals = cleaned(*ledger(), remove_duplicates=remove_duplicates).controls.first()
    copies = 1 if remove_duplicates else 2
    assert totals.raw_rows == 7 and totals.uncomputable_value_count == 1
    assert totals.positive_sales_gbp == 24 * copies + 7.5
    assert (totals.cancellation_value_gbp, totals.other_negative_value_gbp) == (8, 2)
    assert totals.net_value_gbp == 24 * copies + 7.5 - 10
    assert totals.signed_value_positive_price_gbp == 48 + 7.5 - 10
    assert totals.signed_value_nonpositive_price_gbp == -12
    assert DEFAULT["Quantity"] == "3"
