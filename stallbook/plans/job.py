"""One run over one source: read, clean, reconcile, publish.

    spark-submit -m stallbook.plans.job SOURCE OUTPUT
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.plans import chartdata
from stallbook.plans.analysis import CONCURRENT_REPORTS, build_analysis, clean
from stallbook.plans.publish import TABLES, export_json, export_table, run_metadata
from stallbook.plans.switching import Folder, publish, require_apart
from stallbook.schema import Settings
from stallbook.sources.files import read_ledger
from stallbook.sources.fingerprint import fingerprint, listing, require_unchanged
from stallbook.storage import written

METADATA = "run_metadata.json"
CHARTS = tuple(f"{name}.json" for name in ("top_products", "country_sales", "monthly_sales", "sales_to_net", "period"))
LINES = ("eligible_lines", "input_files", "rejected_rows")


def chart_tables(tables: dict[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    overall = tables["overall_summary.csv"]
    return {
        "top_products": chartdata.chart_products(tables["product_summary.csv"], settings.top),
        "country_sales": chartdata.chart_countries(tables["country_summary.csv"], settings),
        "monthly_sales": chartdata.chart_months(tables["monthly_summary.csv"]),
        "sales_to_net": chartdata.chart_net_steps(overall),
        "period": chartdata.chart_period(overall),
    }


def run_analysis(
    spark: SparkSession,
    source: str,
    output: str,
    settings: Settings = Settings(),
    hash_content: bool = True,
    **reading: str | bool,
) -> dict[str, DataFrame]:
    """Publish tables, chart data, eligible lines and metadata; return the nine tables.

    Nothing is published until every table is computed and reconciled and the input
    is known not to have changed, and then all of it or nothing. Metadata says that a run is complete.
    hash_content=False compares file lists instead of reading the files again. reading is what read_ledger takes
    beside the path: form, multi_line, time_zone. Rows that are no lines are published as rejected_rows.
    """
    folder = Folder(spark, output)
    outputs = [*TABLES, *CHARTS, *LINES, METADATA]
    require_apart(folder, source, outputs)
    take_fingerprint = fingerprint if hash_content else listing
    before = written(take_fingerprint(spark, source), "fingerprint")
    ledger = read_ledger(spark, source, **reading)
    cleaned = clean(ledger)
    tables = build_analysis(cleaned, settings)
    require_unchanged(before, take_fingerprint(spark, source))

    charts = {f"{name}.json": table for name, table in chart_tables(tables, settings).items()}
    none = spark.createDataFrame([], "source_file string, source_row bigint, record string")
    frames = {"eligible_lines": cleaned.eligible, "input_files": before, "rejected_rows": none if ledger.rejects is None else ledger.rejects}
    metadata = run_metadata(source, folder.path, outputs, before, cleaned.profile, settings).coalesce(1)
    described = metadata.withColumn("complete", F.lit(True))

    def writer(name: str) -> Callable[[str], None]:
        if name in tables:
            return lambda into: export_table(name, tables[name], into)
        if name in frames:
            return lambda into: frames[name].write.parquet(f"{into}/{name}")
        return lambda into: export_json({**charts, METADATA: described}[name], f"{into}/{name}")

    publish(folder, {name: writer(name) for name in outputs}, METADATA, CONCURRENT_REPORTS)
    return tables


if __name__ == "__main__":
    session = (
        SparkSession.builder.appName("stallbook")
        # A run has more different stages than the usual cache of compiled code holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    run_analysis(session, sys.argv[1], sys.argv[2])
