"""Random dirty ledgers against a line-by-line calculation in plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import RAW_TYPES

from stallbook.operators.lines import judge
from stallbook.plans.analysis import build_analysis, clean, reconcile
from stallbook.schema import EXCLUDED_CODES, RAW_COLUMNS, VALUE_COLUMNS
from stallbook.sources.files import RawLedger

CODES = {code for code, _, _ in EXCLUDED_CODES}
CHOICES = [
    ["100", "101", " 101", "C5", "c6 ", "\tC7", " ", None, " 102 "],
    ["A", " A", "B", "B ", "Z9", "a", "POST", " POST", "post", "m", "M", " ", None],
    ["Zebra", "Apple", " Apple ", "apple", "", " ", None, "Éclair", "Zoë"],
    ["1", "2", "-1", "-3", "0", "1.5", "x", "inf", " 4 ", "1e1", "-0", None, "5d"],
    ["2011-12-01", "2011-12-01 10:00:00", "12/1/2011 8:26", "31/12/2010", "never", None, "2010-01-31T23:59:59"],
    ["1", "2.50", "0.001", "0", "-1", "-0.0", "x", "-inf", "3.333333", None],
    ["001", "1", " 1", "9", " ", None],
    ["United Kingdom", " France", "France", "", " ", None],
]
NUMBERS = {"1e1": Decimal(10), "inf": None, "-inf": None, "x": None, "5d": None}
FORMATS = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y", "%d/%m/%Y"]


def number(text):
    if text is None:
        return None
    return NUMBERS[text] if text in NUMBERS else Decimal(text.strip())


def moment(text):
    for form in FORMATS:
        try:
            return datetime.strptime(text or "", form)
        except ValueError:
            continue
    return None


def rule_of(line):
    invoice, code, _, quantity, date, price, _, _ = line
    invoice, code = (invoice or "").strip(), (code or "").strip()
    quantity, price = number(quantity), number(price)
    if code in CODES:
        return "excluded_codes"
    if not invoice or not code or moment(date) is None or quantity is None or price is None:
        return "invalid_required_fields"
    if quantity % 1:
        return "invalid_required_fields"
    if price < 0:
        return "negative_prices"
    if price == 0:
        return "zero_prices"
    if quantity == 0:
        return "zero_quantities"
    if invoice[0] in "cC" and quantity > 0:
        return "inconsistent_c_positive_quantity"
    return "eligible"


def bucket_of(line):
    """Position of the line's value among sales, cancellations and other negatives."""
    if number(line[3]) > 0:
        return 0
    return 1 if line[0].strip()[0] in "cC" else 2


def add_up(lines, key):
    groups = defaultdict(lambda: [Decimal(0)] * 3)
    for line in lines:
        value = number(line[3]) * number(line[5])
        place = bucket_of(line)
        groups[key(line)][place] += value if place == 0 else -value
    return {name: (s, c, a, s - c - a) for name, (s, c, a) in groups.items()}


def table_values(table, key):
    return {
        row[key] if key else None: tuple(row[name] for name in VALUE_COLUMNS)
        for row in table.collect()
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_ledgers(spark, seed):
    pick = random.Random(seed)
    # Leaning on the first choices keeps enough lines eligible, and copies frequent.
    lines = [
        tuple(choices[min(int(pick.expovariate(0.45)), len(choices) - 1)] for choices in CHOICES)
        for _ in range(900)
    ]
    raw = spark.createDataFrame(
        [(*line, row) for row, line in enumerate(lines, 2)], f"{RAW_TYPES}, source_row bigint"
    ).repartition(7)

    # The reader takes the empty text as missing, so copies are counted after that.
    lines = [tuple(value or None for value in line) for line in lines]
    raw = raw.replace("", None)
    first_rows, copies = {}, Counter(lines)
    for row, line in enumerate(lines, 2):
        first_rows.setdefault(line, row)

    judged = {
        row.source_row: (row.disposition, row.copies) for row in judge(raw).collect()
    }
    assert judged == {
        row: (rule_of(line), copies[line]) for line, row in first_rows.items()
    }

    survivors = [line for line in first_rows if rule_of(line) == "eligible"]
    assert len(survivors) > 20
    cleaned = clean(RawLedger(raw, RAW_COLUMNS))
    tables = build_analysis(cleaned)
    assert all(row.ok for row in reconcile(cleaned, tables).collect())

    products = tables["product_summary.csv"]
    by_code = add_up(survivors, lambda line: line[1].strip())
    assert table_values(products, "StockCode") == by_code
    assert table_values(tables["country_summary.csv"], "Country") == add_up(
        survivors, lambda line: (line[7] or "").strip() or "Unknown"
    )
    assert table_values(tables["monthly_summary.csv"], "Month") == add_up(
        survivors, lambda line: moment(line[4]).strftime("%Y-%m")
    )
    overall = add_up(survivors, lambda line: None)
    assert table_values(tables["overall_summary.csv"], None) == overall

    labels = defaultdict(Counter)
    for line in survivors:
        labels[line[1].strip()][(line[2] or "").strip()] += 1
    for row in products.collect():
        counted = [(-n, label) for label, n in labels[row.StockCode].items() if label]
        assert row.Description == (min(counted)[1] if counted else row.StockCode)
        values = [group[0] for group in by_code.values()]
        nets = [group[3] for group in by_code.values()]
        assert row.positive_sales_rank == 1 + sum(v > row.positive_sales_gbp for v in values)
        assert row.net_value_rank == 1 + sum(v > row.net_value_gbp for v in nets)

    sales = Counter()
    for line in survivors:
        buyer = (line[6] or "").strip()
        if buyer and bucket_of(line) == 0:
            sales[buyer] += number(line[3]) * number(line[5])
    ranked = sorted(sales.items(), key=lambda item: (-item[1], item[0]))
    assert [
        (row.CustomerID, row.positive_sales_gbp)
        for row in tables["customer_summary.csv"].orderBy("display_order").collect()
    ] == ranked

    every = [line for line in lines if rule_of(line) == "eligible"]
    before = add_up(every, lambda line: None)[None]
    compared = {row.metric: row for row in tables["duplicate_comparison.csv"].collect()}
    for place, metric in ((0, "positive_sales_gbp"), (1, "cancellation_value_gbp"), (3, "net_value_gbp")):
        assert compared[metric].before_gbp == before[place]
        assert compared[metric].after_gbp == overall[None][place]

    largest = sorted(
        survivors, key=lambda line: (-abs(number(line[3]) * number(line[5])), first_rows[line])
    )[:10]
    assert {row.source_row for row in tables["large_value_lines.csv"].collect()} == {
        first_rows[line] for line in largest
    }

    steps = {
        row.step: row.removed_rows
        for row in tables["cleaning_summary.csv"].where("record_type = 'removal_step'").collect()
    }
    removed = Counter(rule_of(line) for line in first_rows)
    removed["exact_duplicates"] = len(lines) - len(first_rows)
    assert steps == {step: removed[step] for step in steps}
