"""Removal rules, their order, their audit and the report on excluded codes."""

from decimal import Decimal

import pytest
from conftest import DEFAULT, line

from stallbook.catalog import queries
from stallbook.operators import audit
from stallbook.operators import lines as operators
from stallbook.operators.lines import distinct_lines, eligible_lines, every_copy, judge, judged_lines, stored_lines, with_copy_key
from stallbook.operators.metrics import category_counts
from stallbook.plans.analysis import build_analysis
from stallbook.schema import EXCLUDED_CODES, RAW_COLUMNS, REMOVAL_STEPS
from stallbook.sources.order_lines import raw_order_lines


def steps(cleaned):
    return {row.step: row for row in audit.stage_audit(cleaned.charged).collect()}


def test_every_excluded_code_is_reported_with_its_category(cleaned):
    lines = [line(StockCode=code) for code, _, _ in EXCLUDED_CODES]
    result = cleaned(line(), *lines)
    rows = result.excluded.collect()
    assert {(row.StockCode, row.category, row.reason) for row in rows} == set(EXCLUDED_CODES)
    assert {row.basis for row in rows} == {"post_deduplication"}
    assert {row.row_count for row in rows} == {1}
    # Binary order: capitals before small letters.
    assert [row.StockCode for row in rows] == sorted(code for code, _, _ in EXCLUDED_CODES)
    assert [row.StockCode for row in result.eligible.collect()] == ["TP-4"]


def test_only_whole_codes_in_their_own_case_are_excluded(eligible):
    codes = {code for code, _, _ in EXCLUDED_CODES}
    close = {form for code in codes for form in (f"{code}7", f"7{code}", code[1:], code.swapcase())} - codes - {""}
    found = eligible(*[line(StockCode=code) for code in sorted(close)]).collect()
    assert {row.StockCode for row in found} == close


@pytest.mark.parametrize("code", ["23444", " 23444 ", "\t23444\n", " 23444 ", "\x1c23444"])
def test_codes_match_after_stripping(cleaned, code):
    assert cleaned(line(StockCode=code), line()).excluded.first().StockCode == "23444"


def test_price_statuses_of_an_excluded_code(cleaned):
    """One line for each pair of a quantity and a price, the first pair three times."""
    quantities, prices = ["4", "-1", "half"], ["0.25", "-0.5", "0", "free"]
    fees = [line(StockCode="AMAZONFEE", Quantity=q, UnitPrice=p) for q in quantities for p in prices]
    result = cleaned(*fees, fees[0], fees[0], line())
    row = result.excluded.first()
    counts = ("row_count", "positive_price_row_count", "negative_price_row_count", "zero_price_row_count")
    assert [row[name] for name in counts] == [12, 2, 2, 2]
    assert row.invalid_numeric_row_count == row.uncomputable_value_count == 6
    assert row.signed_value_positive_price_gbp == Decimal("0.75")
    assert row.signed_value_nonpositive_price_gbp == Decimal("-1.5")
    # The code rule comes first, so bad numbers of excluded codes are not charged again.
    assert steps(result)["invalid_required_fields"].removed_rows == 0
    # Without deduplication the copies count.
    raw_basis = audit.excluded_entries(result.judged, remove_duplicates=False).first()
    assert (raw_basis.basis, raw_basis.row_count) == ("raw", 14)
    assert raw_basis.signed_value_positive_price_gbp == Decimal("2.75")


def test_no_excluded_code_gives_an_empty_typed_table(cleaned):
    excluded = cleaned(line()).excluded
    assert excluded.columns == audit.EXCLUSION_COLUMNS
    assert excluded.count() == 0


def test_rules_charge_a_line_to_the_first_that_removes_it(cleaned):
    """A line with every defect at once loses them one by one, from the first rule to the last."""
    defects = [
        {"StockCode": "DOT"},
        {"InvoiceDate": "soon"},
        {"UnitPrice": "-2"},
        {"UnitPrice": "0"},
        {"Quantity": "0"},
        {"InvoiceNo": "C9", "Quantity": "6"},
    ]
    for first, step in enumerate(REMOVAL_STEPS[1:]):
        worst = {}
        for defect in reversed(defects[first:]):
            worst.update(defect)
        result = cleaned(line(**worst), line(**worst), line())
        removed = {name: row.removed_rows for name, row in steps(result).items() if row.removed_rows}
        assert removed == {"exact_duplicates": 1, step: 1}


def test_stage_rows_and_categories(cleaned):
    lines = [
        line(InvoiceNo=f"{number}", StockCode=code, Quantity=quantity, UnitPrice=price)
        for number, (code, quantity, price) in enumerate(
            [("M", "1", "9")] * 2 + [("J3", "x", "9")] * 3 + [("J3", "1", "-9")] * 4 + [("J3", "2", "6")] * 5
        )
    ]
    lines += [line(InvoiceNo="c50", StockCode="J3", Quantity="-1", UnitPrice="6"), line(InvoiceNo="51", Quantity="-1")]
    result = cleaned(*lines, *lines[:2])
    rows = audit.stage_audit(result.charged).orderBy("step_no").collect()
    assert [row.step for row in rows] == REMOVAL_STEPS
    assert [(row.input_rows, row.removed_rows, row.remaining_rows) for row in rows] == [
        (18, 2, 16), (16, 2, 14), (14, 3, 11), (11, 4, 7), (7, 0, 7), (7, 0, 7), (7, 0, 7),
    ]
    total = audit.eligible_total(result.charged).first()
    assert total.remaining_rows == 7
    assert total.remaining_signed_value_positive_price_gbp == 5 * 12 - 6 - 8
    assert {row.transaction_category: row.row_count for row in category_counts(result.lines).collect()} == {
        "positive_sale": 5, "cancellation": 1, "other_negative": 1,
    }


UNUSABLE = {
    "InvoiceNo": [None, "\t", "\u2003"],
    "StockCode": [None, "\xa0"],
    "InvoiceDate": [None, "yesterday", "2011-02-30"],
    "Quantity": [None, "two", "2.25", "-inf", "1e-3"],
    "UnitPrice": [None, "", "nan", "inf", "7f", "1,5"],
}


def test_unusable_fields_are_charged_to_one_rule(cleaned):
    """All in one ledger: each line has one bad field, and a description that tells it from the others."""
    bad = [(name, value) for name, values in UNUSABLE.items() for value in values]
    result = cleaned(line(), *[line(**{name: value}, Description=f"bad {k}") for k, (name, value) in enumerate(bad)])
    assert {name: row.removed_rows for name, row in steps(result).items() if row.removed_rows} == {"invalid_required_fields": len(bad)}
    assert [row.Description for row in result.eligible.collect()] == [DEFAULT["Description"]]


@pytest.mark.parametrize("blank", [None, "", " \t"])
def test_a_sale_needs_no_label_buyer_or_country(eligible, blank):
    row = eligible(line(), line(Description=blank, CustomerID=blank, Country=blank)).where("source_row = 3").first()
    assert (row.Description, row.CustomerID, row.Country) == ("", None, "Unknown")
    assert row.signed_value_gbp == 24


def test_lines_that_differ_only_in_blanks_are_no_copies(eligible):
    forms = ["LAMP", "LAMP", "LAMP ", " LAMP", "LAMP "]
    rows = eligible(*[line(StockCode=form, CustomerID=None) for form in forms]).collect()
    assert {(row.StockCode, row.source_row) for row in rows} == {("LAMP", 2), ("LAMP", 4), ("LAMP", 5)}


@pytest.mark.parametrize("copies", [1, 4])
def test_kept_copies_reach_audit_lines_and_exclusions(cleaned, copies):
    lines = [line(Quantity="7", UnitPrice="1.5")] * copies + [line(StockCode="BANK CHARGES")] * copies
    kept = cleaned(*lines, remove_duplicates=False)
    assert steps(kept)["exact_duplicates"].removed_rows == 0
    total = audit.eligible_total(kept.charged).first()
    assert total.remaining_rows == kept.eligible.count() == copies
    assert total.remaining_signed_value_positive_price_gbp == Decimal("10.5") * copies
    excluded = kept.excluded.first()
    assert (excluded.basis, excluded.row_count) == ("raw", copies)
    removed = cleaned(*lines)
    assert steps(removed)["exact_duplicates"].removed_rows == 2 * (copies - 1)
    assert removed.eligible.count() == 1


def test_every_copy_counts_in_all_tables_with_duplicates_kept(cleaned):
    sale = line(InvoiceNo="7001", StockCode="K9", Quantity="4", UnitPrice="2.5")
    lines = [sale, sale, sale, line(InvoiceNo="C7002", StockCode="K9", Quantity="-1", UnitPrice="2.5")]
    kept = cleaned(*lines, remove_duplicates=False)
    assert sorted(row.source_row for row in kept.eligible.collect()) == [2, 3, 4, 5]
    tables = build_analysis(kept)
    product = tables["product_summary.csv"].first().asDict()
    audited = audit.eligible_total(kept.charged).first()
    assert audited.remaining_rows == 4
    assert audited.remaining_signed_value_positive_price_gbp == product["net_value_gbp"] == 27.5
    removed = build_analysis(cleaned(*lines))["product_summary.csv"].first()
    assert removed.net_value_gbp == 7.5


def test_copies_are_found_again_as_if_each_had_been_judged(spark):
    lines = raw_order_lines(spark, "/root/testdata/sf0.001", numbered=True)
    found = every_copy(stored_lines(with_copy_key(judge(lines)).drop(*RAW_COLUMNS)), lines)
    again = judged_lines(lines.selectExpr("*", "1L AS copies")).drop(*RAW_COLUMNS)
    assert found.count() == again.count() == lines.count()
    assert found.select(*again.columns).exceptAll(again).isEmpty()
    # What parses a quantity is in the plan of the judged lines alone.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in plan.lower() and "rlike" not in plan.lower()


def test_copies_of_lines_that_nearly_agree_are_kept_apart(raw):
    cells = [("12", None), (None, "12"), ("1", "2"), ("-", None), (None, "-"), (None, None), ("", "3:abc"), ("3:abc", "")]
    lines = raw(*[line(InvoiceNo=a, StockCode=b) for a, b in cells * 3])
    found = every_copy(stored_lines(with_copy_key(judge(lines)).drop(*RAW_COLUMNS)), lines)
    texts = {row.source_row: (row.invoice, row.code) for row in found.collect()}
    assert texts == {k: tuple((c or "").strip() for c in cell) for k, cell in enumerate(cells * 3, 2)}


def test_only_cancellations_are_a_valid_population(cleaned):
    result = cleaned(line(InvoiceNo="C1", Quantity="-2"))
    assert result.eligible.first().transaction_category == "cancellation"


def test_copies_keep_their_count_and_first_row(raw):
    row = distinct_lines(raw(line(), line(StockCode="Z"), line(), line())).where(
        "StockCode = 'TP-4'"
    ).first()
    assert (row.copies, row.source_row) == (3, 2)


def test_audit_values_stay_exact_with_very_many_copies(spark, raw):
    from pyspark.sql import functions as F

    judged = judge(raw(line(Quantity="3", UnitPrice="0.000001"))).withColumn(
        "copies", F.lit(333_333_333_333).cast("bigint")
    )
    row = audit.audit_values(judged, F.col("copies")).first()
    assert row.row_count == 333_333_333_333
    assert str(row.signed_value_positive_price_gbp) == "999999.999999000"


def test_the_largest_values_need_no_copies_to_be_audited(cleaned):
    result = cleaned(line(Quantity="999999999999999", UnitPrice="100000000000"))
    total = audit.eligible_total(result.charged).first()
    assert total.remaining_signed_value_positive_price_gbp == 999999999999999 * 100000000000


def test_products_beyond_capacity_fail(eligible):
    with pytest.raises(Exception, match="larger than the ledger can hold"):
        eligible(line(Quantity="1e16", UnitPrice="1e13")).collect()


@pytest.mark.parametrize(
    "quantity, price, value",
    [
        ("3", "1000000000000000", "3000000000000000"),
        ("3", "2e12", "6000000000000"),
        ("10000000000000000", "0.5", "5000000000000000"),
        ("1", "0.0000000001", "0"),
        ("1000000000", "0.0000000001", "0.1"),
        ("1000", "0.00000123456789", "0.001234568"),
        ("1", "0.30000000000000004", "0.3"),
        ("-7", "0.123456789012345678", "-0.864197523"),
    ],
)
def test_finite_numbers_stay_as_they_are_in_the_source(cleaned, quantity, price, value):
    lines = [line(Quantity=quantity, UnitPrice=price)] * 3
    result = cleaned(*lines)
    row = result.eligible.first()
    assert (row.Quantity, row.UnitPrice, row.signed_value_gbp) == (Decimal(quantity), Decimal(price), Decimal(value))
    build_analysis(result)
    large = row.signed_value_gbp * 3
    assert audit.audit_values(result.judged, result.judged.copies).first().signed_value_positive_price_gbp == large


@pytest.mark.parametrize(
    "quantity, price, value",
    [
        ("3", "0.30000000000000004", "0.900000000"),
        ("8", "1.2345678", "9.876542400"),
        ("1.23456", "10", "12.345600000"),
        ("3", "0.000001", "0.000003000"),
    ],
)
def test_every_finite_number_has_its_value(raw, quantity, price, value):
    row = judge(raw(line(Quantity=quantity, UnitPrice=price))).first()
    assert str(row.signed_value) == value


def test_line_order_and_partitions_do_not_matter(spark, raw):
    lines = [
        line(InvoiceNo=str(number % 7), Quantity=str(number % 5 - 2), UnitPrice=f"{number % 11}.{number % 3}")
        for number in range(200)
    ]
    expected = None
    for partitions in (1, 4, 37):
        frame = raw(*lines).orderBy("Quantity", "UnitPrice").repartition(partitions)
        found = sorted(map(tuple, eligible_lines(judge(frame)).collect()))
        expected = expected or found
        assert found == expected
    assert DEFAULT["StockCode"] == found[0][1]


def test_copies_without_row_numbers_come_from_their_count(raw, monkeypatch):
    monkeypatch.setattr(operators, "COPIES_AT_ONCE", 3)
    cells = [("7", None), (None, "7"), ("8", "K1"), ("9", "K2")]
    times = [10, 3, 4, 1]
    rows = [line(InvoiceNo=a, StockCode=b) for (a, b), n in zip(cells, times) for _ in range(n)]
    lines = raw(*rows).drop("source_row")
    found = every_copy(stored_lines(with_copy_key(judge(lines)).drop(*RAW_COLUMNS)), lines)
    counted = {(row.invoice, row.code): row["count"] for row in found.groupBy("invoice", "code").count().collect()}
    assert counted == {(a or "", b or ""): n for (a, b), n in zip(cells, times)}
    assert {row.copies for row in found.collect()} == {1}
    # The raw lines are not derived again.
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_lines_without_dedup_derive_the_raw_lines_once(spark):
    found = queries._every_line(spark, "/root/testdata/sf0.001", numbered=True)
    assert not [file for file in found.inputFiles() if "/root/testdata" in file]


def test_eligible_lines_store_only_what_they_show(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(queries, "stored_lines", lambda judged: stored.append(judged.columns) or stored_lines(judged))
    assert queries.REGISTERED["eligible_lines"](spark, "/root/testdata/sf0.001").count()
    assert not {*RAW_COLUMNS, "missing", "price_number", "computable"}.intersection(stored[0])
