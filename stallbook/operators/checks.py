"""Reconciliation: every check is one row of (check, actual, expected, ok)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.operators.audit import PARTITIONS, STATUS_COUNTS
from stallbook.operators.controls import RAW_ROWS
from stallbook.operators.lines import ELIGIBLE, category
from stallbook.operators.metrics import difference, total
from stallbook.schema import AUDIT_COLUMNS, CATEGORIES, MONEY, VALUE_COLUMNS

# Two unrounded totals agree within either tolerance.
RELATIVE_TOLERANCE = 1e-12
ABSOLUTE_TOLERANCE = 1e-6

EMPTY = "No eligible merchandise remains after cleaning."


def agrees(actual: Column, expected: Column) -> Column:
    actual, expected = actual.cast("double"), expected.cast("double")
    largest = F.greatest(F.abs(actual), F.abs(expected))
    allowed = F.greatest(largest * RELATIVE_TOLERANCE, F.lit(ABSOLUTE_TOLERANCE))
    return F.coalesce(F.abs(actual - expected) <= allowed, F.lit(False))


def _check(label: Column, actual: Column, expected: Column) -> Column:
    return F.struct(
        label.alias("check"), actual.cast(MONEY).alias("actual"), expected.cast(MONEY).alias("expected")
    )


def _rows(df: DataFrame, checks: list[Column]) -> DataFrame:
    return (
        df.select(F.explode(F.array(*checks)).alias("entry"))
        .select("entry.check", "entry.actual", "entry.expected")
        .withColumn("ok", agrees(F.col("actual"), F.col("expected")))
    )


def stage_checks(stages: DataFrame) -> DataFrame:
    """Input is removed plus remaining, in rows, values and uncomputable counts."""
    return _rows(
        stages,
        [
            _check(
                F.concat("step", F.lit(f": {name}")),
                F.col(f"removed_{name}") + F.col(f"remaining_{name}"),
                F.col(f"{PARTITIONS[0]}_{name}"),
            )
            for name in ["rows", *AUDIT_COLUMNS]
        ],
    )


def row_checks(charged: DataFrame, profile: DataFrame) -> DataFrame:
    """All raw rows are charged to a rule or eligible."""
    raw_rows = profile.select("rows").scalar()
    return _rows(
        charged.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("charged")),
        [_check(F.lit("raw rows"), F.col("charged"), raw_rows)],
    )


def exclusion_checks(excluded: DataFrame, charged: DataFrame) -> DataFrame:
    """Status counts of each code add up; all codes add up to the excluding rule."""
    measures = ["row_count", *AUDIT_COLUMNS]
    statuses = reduce(lambda left, right: left + right, map(F.col, STATUS_COUNTS.values()))
    by_code = _rows(
        excluded,
        [_check(F.concat(F.lit("price statuses of "), "StockCode"), statuses, F.col("row_count"))],
    )
    rule = charged.where(F.col("disposition") == "excluded_codes")
    found = excluded.agg(*[total(F.col(name)).alias(name) for name in measures])
    wanted = rule.agg(*[total(F.col(name)).alias(name) for name in measures])
    return by_code.unionByName(_compare("excluded codes", found, wanted, measures))


def category_checks(judged: DataFrame) -> DataFrame:
    """Every eligible line has a known category, and S - C - A is the signed sum."""
    lines = judged.where(F.col("disposition") == ELIGIBLE).select(
        "signed_value", category().alias("category")
    )
    known = F.coalesce(F.col("category").isin(CATEGORIES), F.lit(False))
    sums = [
        total(F.when(F.col("category") == name, F.col("signed_value"))).alias(name)
        for name in CATEGORIES
    ]
    sales, cancelled, others = map(F.col, CATEGORIES)
    return _rows(
        lines.agg(
            F.count_if(~known).alias("unclassified"),
            total(F.col("signed_value")).alias("signed"),
            *sums,
        ),
        [
            _check(F.lit("unclassified eligible rows"), F.col("unclassified"), F.lit(0)),
            _check(
                F.lit("signed value of eligible lines as S - C - A"),
                F.col("signed"),
                # Cancellations and other negatives are still signed here.
                difference(sales, -cancelled, -others),
            ),
        ],
    )


def customer_checks(overall: DataFrame) -> DataFrame:
    return _rows(
        overall,
        [
            _check(
                F.lit("sales of known and unknown customers"),
                difference(
                    F.col("identified_positive_sales_gbp"),
                    -F.col("unidentified_positive_sales_gbp"),
                ),
                F.col("positive_sales_gbp"),
            )
        ],
    )


def _compare(label: str, found: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """Compare two one-row frames column by column, matched by name."""

    def tall(df: DataFrame, value: str) -> DataFrame:
        return df.select(*[F.col(name).cast(MONEY).alias(name) for name in names]).unpivot(
            [], names, "name", value
        )

    return (
        tall(found, "actual")
        .join(tall(wanted, "expected"), "name", "full")
        .select(
            F.concat(F.lit(f"{label}: "), "name").alias("check"),
            "actual",
            "expected",
            agrees(F.col("actual"), F.col("expected")).alias("ok"),
        )
    )


def group_checks(overall: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """S, C, A and N of every grouping add up to the overall ones."""
    return reduce(
        DataFrame.unionByName,
        [
            _compare(
                label,
                table.agg(*[total(F.col(name)).alias(name) for name in VALUE_COLUMNS]),
                overall,
                VALUE_COLUMNS,
            )
            for label, table in tables.items()
        ],
    )


def control_checks(
    controls: DataFrame, charged: DataFrame, tables: dict[str, DataFrame]
) -> DataFrame:
    """What the rules were charged with, and every table, against control totals taken elsewhere."""
    measures = {"row_count": RAW_ROWS, **{name: name for name in AUDIT_COLUMNS}}
    charges = charged.agg(*[total(F.col(name)).alias(to) for name, to in measures.items()])
    return reduce(
        DataFrame.unionByName,
        [
            _compare("charged", charges, controls, list(measures.values())),
            *[
                _compare(label, table.agg(*[total(F.col(name)).alias(name) for name in VALUE_COLUMNS]), controls, VALUE_COLUMNS)
                for label, table in tables.items()
            ],
        ],
    )


def require_all(checks: DataFrame) -> None:
    """Fail with the first check that does not hold."""
    failed = checks.where(~F.col("ok")).orderBy("check").first()
    if failed is not None:
        raise ValueError(
            f"Reconciliation failed for {failed['check']}: "
            f"{failed['actual']} versus {failed['expected']}"
        )


def require_lines(charged: DataFrame) -> None:
    """Fail when no row is left; charged is the small table of audit_by_disposition."""
    if charged.where((F.col("disposition") == ELIGIBLE) & (F.col("row_count") > 0)).isEmpty():
        raise ValueError(EMPTY)
