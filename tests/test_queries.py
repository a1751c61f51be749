"""Every registered query against its SQL, and the planted defects against known totals."""

import pytest

import check_oracle
from __spark_entry__ import entry, oracle_sql, queries
from stallbook.catalog.queries import REGISTERED
from stallbook.operators.audit import audit_by_disposition
from stallbook.operators.lines import judge
from stallbook.plans.publish import is_integer, is_two_decimal
from stallbook.sources.order_lines import raw_order_lines

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_sql(spark, duck, name):
    result = check_oracle.compare(spark, duck, FOLDER, name)
    assert result is None or result.startswith("rows only")


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(REGISTERED) <= set(queries())
    # The corpus operators, where present, have tests of their own.
    assert set(REGISTERED) - set(oracle_sql()) == {
        "source_fingerprint", "input_unchanged", "run_metadata",
    }


def test_entry_has_rows(spark):
    assert entry(spark).count() == 200


def test_planted_defects_are_all_found(spark):
    charged = audit_by_disposition(judge(raw_order_lines(spark, FOLDER))).collect()
    assert {row.disposition: row.row_count for row in charged} == {
        "exact_duplicates": 62,
        "excluded_codes": 208,
        "invalid_required_fields": 58,
        "negative_prices": 8,
        "zero_prices": 13,
        "zero_quantities": 12,
        "inconsistent_c_positive_quantity": 16,
        "eligible": 5685,
    }


def test_export_forms():
    assert is_two_decimal("change_gbp") and is_two_decimal("percentage_change")
    assert is_integer("net_value_rank") and is_integer("Quantity")
    assert not is_integer("UnitPrice")
