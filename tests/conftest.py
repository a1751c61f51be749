import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stallbook.schema import RAW_COLUMNS  # noqa: E402

RAW_TYPES = ", ".join(f"{name} string" for name in RAW_COLUMNS)
DEFAULT = {
    "InvoiceNo": "9000",
    "StockCode": "TP-4",
    "Description": "Blue teapot",
    "Quantity": "3",
    "InvoiceDate": "2011-06-14 09:30:00",
    "UnitPrice": "8",
    "CustomerID": "70001",
    "Country": "United Kingdom",
}
EDGE = {**DEFAULT, "StockCode": "LAMP", "Description": "Desk lamp", "Quantity": "1"}


def line(base=DEFAULT, **changes):
    """One raw line as a tuple; changes override the base."""
    return tuple({**base, **changes}[name] for name in RAW_COLUMNS)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("stallbook-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Lines in the given order, numbered from 2 as if below a header."""

    def make(*lines):
        rows = [(*values, number) for number, values in enumerate(lines, 2)]
        return spark.createDataFrame(rows, f"{RAW_TYPES}, source_row bigint")

    return make


@pytest.fixture
def cleaned(raw):
    from stallbook.plans.analysis import clean
    from stallbook.sources.files import RawLedger

    def make(*lines, **options):
        return clean(RawLedger(raw(*lines), RAW_COLUMNS), **options)

    return make


@pytest.fixture
def eligible(raw):
    from stallbook.operators.lines import eligible_lines, judge

    def make(*lines):
        return eligible_lines(judge(raw(*lines)))

    return make
