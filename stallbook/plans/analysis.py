"""The nine tables of one ledger."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from stallbook.operators import audit, checks, controls, summaries
from stallbook.operators.lines import classified_lines, eligible_lines, every_copy, judge, line_shares, with_copy_key
from stallbook.operators.profile import combined_profile, profile_sums
from stallbook.operators.sensitivity import comparison_table
from stallbook.plans.publish import in_published_order
from stallbook.schema import RAW_COLUMNS, Settings
from stallbook.sources.files import RawLedger
from stallbook.storage import written

CONCURRENT_REPORTS = 4


@dataclass(frozen=True)
class CleanLedger:
    """Judged lines and what follows from them; charged, profile and controls are a few rows.

    lines are those of counted, classified; eligible are the ones of them that the tables are made of.
    judged has distinct lines with their copies; counted has the lines that the tables count, which
    are the same or, with duplicates kept, every copy as a line of its own.
    """

    judged: DataFrame
    counted: DataFrame
    lines: DataFrame
    eligible: DataFrame
    charged: DataFrame
    excluded: DataFrame
    profile: DataFrame
    cleaning: DataFrame
    controls: DataFrame


def audit_and_profile(
    judged: DataFrame, column_names: list[str] = RAW_COLUMNS, remove_duplicates: bool = True
) -> tuple[DataFrame, DataFrame]:
    """What the rules removed and what the raw rows looked like, from one pass."""
    groups = written(audit.audit_groups(judged, *profile_sums()), "audit")
    return audit.charges(groups, remove_duplicates), combined_profile(groups, column_names)


def clean(ledger: RawLedger, remove_duplicates: bool = True) -> CleanLedger:
    """Judge the raw lines once and write them; all reports read only their columns.

    With remove_duplicates off, the duplicate rule removes nothing and every copy
    counts, under otherwise equal rules. Stored lines are judged in shares.
    """
    both = controls.audited() + controls.counted()
    shares = [judge(share) for share in (line_shares(ledger.lines) if ledger.stored else [ledger.lines])]
    if not remove_duplicates:
        shares = [with_copy_key(share) for share in shares]
    judged, totals = controls.written_with_totals([share.drop(*RAW_COLUMNS) for share in shares], "judged", both)
    counted = judged
    if not remove_duplicates:
        counted, kept = controls.written_with_totals(
            [every_copy(judged, ledger.lines)], "judged-copies", controls.counted()
        )
        totals = {**totals, **kept}
    charged, profile = audit_and_profile(judged, ledger.column_names, remove_duplicates)
    return CleanLedger(
        judged=judged,
        counted=counted,
        lines=classified_lines(counted),
        eligible=eligible_lines(counted),
        charged=charged,
        excluded=audit.excluded_entries(judged, remove_duplicates),
        profile=profile,
        cleaning=audit.cleaning_summary(charged, profile),
        controls=controls.controls(ledger.lines, totals),
    )


def reconcile(cleaned: CleanLedger, tables: dict[str, DataFrame]) -> DataFrame:
    """All checks of one run as rows."""
    overall = tables["overall_summary.csv"]
    return reduce(
        DataFrame.unionByName,
        [
            checks.stage_checks(audit.stage_audit(cleaned.charged)),
            checks.row_checks(cleaned.charged, cleaned.profile),
            checks.exclusion_checks(tables["excluded_entries.csv"], cleaned.charged),
            checks.category_checks(cleaned.counted),
            checks.customer_checks(overall),
            checks.group_checks(
                overall,
                {
                    "products": tables["product_summary.csv"],
                    "countries": tables["country_summary.csv"],
                    "months": tables["monthly_summary.csv"],
                },
            ),
        ],
    )


def compare_controls(cleaned: CleanLedger, tables: dict[str, DataFrame]) -> DataFrame:
    """All tables of one run against its control totals, as rows."""
    labels = {"overall": "overall", "products": "product", "countries": "country", "months": "monthly"}
    return checks.control_checks(
        cleaned.controls,
        cleaned.charged,
        {label: tables[f"{name}_summary.csv"] for label, name in labels.items()},
    )


def build_tables(cleaned: CleanLedger, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """The nine tables by name, each computed once and written.

    The reports are independent jobs, so they run side by side.
    """
    checks.require_lines(cleaned.charged)
    lines = cleaned.eligible
    with ThreadPoolExecutor(CONCURRENT_REPORTS) as pool:
        # Two passes over the lines leave all that six of the tables need.
        totals_job = pool.submit(written, summaries.country_month_totals(lines), "totals")
        # The comparison is always of distinct lines with all their copies.
        compared_job = totals_job
        if cleaned.counted is not cleaned.judged:
            distinct = summaries.country_month_totals(eligible_lines(cleaned.judged))
            compared_job = pool.submit(written, distinct, "compared")
        customers_job = pool.submit(written, summaries.customer_totals(lines), "customers")
        reports = {
            "overall_summary.csv": lambda: summaries.overall_table(
                totals_job.result(), customers_job.result()
            ),
            "product_summary.csv": lambda: summaries.product_summary(lines),
            "country_summary.csv": lambda: summaries.country_table(totals_job.result()),
            "monthly_summary.csv": lambda: summaries.month_table(totals_job.result(), settings),
            "customer_summary.csv": lambda: summaries.customer_table(customers_job.result()),
            "duplicate_comparison.csv": lambda: comparison_table(compared_job.result()),
            "excluded_entries.csv": lambda: cleaned.excluded,
            "cleaning_summary.csv": lambda: cleaned.cleaning,
            "large_value_lines.csv": lambda: summaries.large_value_lines(lines),
        }

        def build(name: str) -> DataFrame:
            # Rows read back are in no order, so the order is put on what is returned.
            return in_published_order(name, written(reports[name](), name.removesuffix(".csv")))

        return dict(zip(reports, pool.map(build, reports)))


def build_analysis(cleaned: CleanLedger, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """The nine tables, after all of them reconcile."""
    tables = build_tables(cleaned, settings)
    checks.require_all(reconcile(cleaned, tables).unionByName(compare_controls(cleaned, tables)))
    return tables
