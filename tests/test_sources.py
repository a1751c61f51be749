"""Reading CSV and Parquet, row numbers, the raw profile and fingerprints."""

import datetime
import hashlib

import pytest
from conftest import DEFAULT, RAW_TYPES, line
from pyspark.sql import functions as F

from stallbook.functions import dates, numbers, text
from stallbook.operators.lines import distinct_lines, eligible_lines, judge, parsed_lines
from stallbook.operators.profile import raw_profile
from stallbook.plans.analysis import clean
from stallbook.schema import RAW_COLUMNS
from stallbook.sources.files import read_csv, read_frame, read_ledger, read_parquet
from stallbook.sources.fingerprint import (
    changed_files,
    fingerprint,
    listing,
    require_unchanged,
)
from stallbook.sources import numbering

HEADER = ",".join(RAW_COLUMNS)


def profile_of(frame, names=RAW_COLUMNS):
    return raw_profile(parsed_lines(distinct_lines(frame)), names).first()


def test_text_survives_reading(spark, tmp_path):
    path = tmp_path / "ledger.csv"
    path.write_text(
        f'{HEADER}\n00100,NA,"PAPER, ""CRAFT""",5,2011-01-05 10:00:00,1.5,00123,UK\n'
        '101,A1,"",-1,1/5/2011 8:26,2,,\n',
        encoding="utf-8",
    )
    ledger = read_ledger(spark, str(path))
    first, second = ledger.lines.orderBy("source_row").collect()
    assert (first.InvoiceNo, first.StockCode, first.CustomerID) == ("00100", "NA", "00123")
    assert first.Description == 'PAPER, "CRAFT"'
    assert (first.source_row, second.source_row) == (2, 3)
    assert (second.Description, second.CustomerID, second.Country) == (None, None, None)
    assert ledger.column_names == RAW_COLUMNS


def test_columns_are_found_by_name_and_extras_dropped(spark, tmp_path):
    path = tmp_path / "shuffled.csv"
    names = ["Extra", *reversed(RAW_COLUMNS)]
    values = {**DEFAULT, "Extra": "x"}
    path.write_text(",".join(names) + "\n" + ",".join(values[name] for name in names) + "\n")
    ledger = read_csv(spark, str(path))
    assert ledger.lines.columns == [*RAW_COLUMNS, "source_row"]
    assert ledger.lines.drop("source_row").first() == line()
    profile = clean(ledger).profile.first()
    assert profile.columns == 9
    assert profile.column_names == names


def test_missing_path_and_missing_column(spark, tmp_path):
    for reader in (read_csv, read_parquet):
        with pytest.raises(FileNotFoundError, match="Input workbook not found: .*absent"):
            reader(spark, str(tmp_path / "absent"))
    path = tmp_path / "short.csv"
    path.write_text(",".join(RAW_COLUMNS[:-1]) + "\n")
    with pytest.raises(ValueError, match="Missing required columns: Country"):
        read_csv(spark, str(path))
    with pytest.raises(ValueError, match="Missing required columns: StockCode, Country"):
        read_frame(spark.createDataFrame([line()], RAW_TYPES).drop("Country", "StockCode"))


def test_files_with_another_header_are_not_misread(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "\n" + ",".join(line()) + "\n")
    names = list(reversed(RAW_COLUMNS))
    (folder / "b.csv").write_text(
        ",".join(names) + "\n" + ",".join(DEFAULT[name] for name in names) + "\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder)).lines.collect()


def numbered_values(lines):
    return [row.InvoiceNo for row in lines.orderBy("source_row").collect()], sorted(
        row.source_row for row in lines.collect()
    )


def test_parquet_rows_are_numbered_across_files(spark, tmp_path):
    folder = str(tmp_path / "parts")
    frame = spark.range(1000).select(
        F.col("id").cast("string").alias("InvoiceNo"),
        *[F.lit(DEFAULT[name]).alias(name) for name in RAW_COLUMNS[1:]],
    )
    frame.coalesce(1).write.option("maxRecordsPerFile", 130).parquet(folder)
    lines = read_parquet(spark, folder).lines
    values, rows = numbered_values(lines)
    assert rows == list(range(2, 1002))
    assert values == [str(number) for number in range(1000)]


def test_csv_rows_are_numbered_across_splits_and_files(spark, tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    expected = []
    for part, count in enumerate((700, 20, 1500)):
        names = [f"{part}-{number}" for number in range(count)]
        rest = ",".join(DEFAULT[name] for name in RAW_COLUMNS[1:])
        (folder / f"part-{part}.csv").write_text(
            HEADER + "\n" + "".join(f"{name},{rest}\n" for name in names)
        )
        expected += names
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        lines = read_csv(spark, str(folder)).lines
        assert lines.rdd.getNumPartitions() > 3
        values, rows = numbered_values(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == list(range(2, 2222))
    assert values == expected


def test_rows_of_any_frame_are_numbered(spark):
    frame = spark.createDataFrame([line(InvoiceNo=str(number)) for number in range(50)], RAW_TYPES)
    values, rows = numbered_values(read_frame(frame.coalesce(1)).lines)
    assert rows == list(range(2, 52))
    assert values == [str(number) for number in range(50)]


def test_own_row_numbers_are_kept(spark):
    frame = spark.createDataFrame([(*line(), 77)], f"{RAW_TYPES}, source_row int")
    assert read_frame(frame).lines.first().source_row == 77


@pytest.mark.parametrize("limit", [500_000, 0])
def test_repeated_rows_are_numbered_without_gaps(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(numbering, "BLOCK_ROWS", 16)
    monkeypatch.setattr(numbering, "BROADCAST_PIECES", limit)
    folder = str(tmp_path / f"rows{limit}")
    spark.range(200).coalesce(1).write.option("maxRecordsPerFile", 70).parquet(folder)
    rows = spark.read.parquet(folder).select(
        "id",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("at"),
        F.explode(F.when(F.col("id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    numbered = numbering.number_repeated_rows(
        rows, F.col("path"), F.col("at"), F.col("copy")
    ).orderBy("source_row").collect()
    assert [row.source_row for row in numbered] == list(range(2, 242))
    assert [(row.id, row["copy"]) for row in numbered] == sorted(
        (number, copy) for number in range(200) for copy in ((0, 1) if number % 5 == 0 else (0,))
    )


def test_typed_columns_become_text(spark, tmp_path):
    folder = str(tmp_path / "typed")
    spark.createDataFrame(
        [
            (536365.0, "23444", 6, datetime.datetime(2010, 12, 1, 8, 26), 2.55, 17850.0),
            (float("nan"), "x", 1, datetime.datetime(2010, 12, 1, 8, 26), 0.0001, None),
            (1.5, "x", 1, datetime.datetime(2010, 12, 1, 8, 26), float("inf"), 1.0),
        ],
        "InvoiceNo double, StockCode string, Quantity int, InvoiceDate timestamp_ntz,"
        " UnitPrice double, CustomerID double",
    ).withColumns({"Description": F.lit("d"), "Country": F.lit("UK")}).coalesce(1).write.parquet(folder)
    first, second, third = read_parquet(spark, folder).lines.orderBy("source_row").collect()
    assert (first.InvoiceNo, first.Quantity, first.CustomerID) == ("536365", "6", "17850")
    assert first.InvoiceDate == "2010-12-01 08:26:00"
    assert second.InvoiceNo is None and second.CustomerID is None
    assert third.InvoiceNo == "1.5"
    judged = {row.source_row: row for row in judge(read_parquet(spark, folder).lines).collect()}
    assert judged[2].disposition == "excluded_codes"
    assert float(judged[3].price_exact) == 0.0001
    assert not judged[4].computable


@pytest.mark.parametrize(
    "value, expected",
    [
        ("5", 5.0), (" 5\t", 5.0), ("+5", 5.0), ("-2", -2.0), (".5", 0.5), ("5.", 5.0),
        ("1e3", 1000.0), ("1E-2", 0.01), ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("5d", None), ("5f", None), ("0x1p3", None), ("1,000", None), ("", None), (" ", None),
        ("bad", None), ("nan", None), ("1e", None), ("--1", None), (None, None), ("infinite", None),
    ],
)
def test_numbers(spark, value, expected):
    frame = spark.createDataFrame([(value,)], "s string")
    row = frame.select(
        numbers.number(F.col("s")).alias("n"),
        numbers.is_finite(numbers.number(F.col("s"))).alias("finite"),
    ).first()
    assert row.n == expected
    assert row.finite == (expected is not None and abs(expected) != float("inf"))


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2011-01-05 10:00:00", "2011-01-05 10:00:00"),
        ("2011-01-05", "2011-01-05 00:00:00"),
        ("2011-01-05T10:00:00", "2011-01-05 10:00:00"),
        ("12/1/2010 8:26", "2010-12-01 08:26:00"),
        ("13/1/2010 8:26", "2010-01-13 08:26:00"),
        ("1/13/2010", "2010-01-13 00:00:00"),
        ("not a date", None),
        ("2011-02-30", None),
        ("20/20/2010", None),
        (None, None),
    ],
)
def test_dates(spark, value, expected):
    frame = spark.createDataFrame([(value,)], "s string")
    assert frame.select(dates.second(dates.timestamp(F.col("s")))).first()[0] == expected


def test_normalised_text(spark):
    rows = spark.createDataFrame([(" c101 ",), ("101",), (None,), ("   ",)], "s string").select(
        text.is_cancellation(F.col("s")).alias("cancels"),
        text.identifier(F.col("s")).alias("identifier"),
        text.customer(F.col("s")).alias("customer"),
        text.country(F.col("s")).alias("country"),
    ).collect()
    assert [tuple(row) for row in rows] == [
        (True, "c101", "c101", "c101"),
        (False, "101", "101", "101"),
        (False, "", None, "Unknown"),
        (False, "", None, "Unknown"),
    ]


def test_profile_of_signs_and_missing_values(raw):
    lines = [line(), line(InvoiceNo=" c101 ", Quantity="-2"), line(Quantity="-1", CustomerID=None)]
    profile = profile_of(raw(*lines))
    assert (profile.rows, profile.columns) == (3, 8)
    assert profile.missing_by_column["CustomerID"] == 1
    assert sum(profile.missing_by_column.values()) == 1
    assert profile.c_prefixed_invoice_rows == 1
    assert profile.negative_quantity_rows == 2
    assert profile.negative_quantity_without_c_prefix == 1
    assert (profile.minimum_quantity, profile.maximum_quantity) == (-2.0, 3.0)
    # A copy in all eight columns is a duplicate, other columns do not matter.
    again = profile_of(raw(*lines, lines[0], line(Description="Other")))
    assert again.exact_duplicates_beyond_first == 1
    assert again.rows == 5


def test_profile_of_dirty_rows(raw):
    profile = profile_of(
        raw(
            line(InvoiceNo="C1", Quantity="0", UnitPrice="0"),
            line(Quantity="1.5", UnitPrice="-1"),
            line(Quantity="bad", UnitPrice="inf"),
            line(Quantity="inf", UnitPrice="x", InvoiceDate="not a date"),
            line(InvoiceDate=None),
        )
    )
    assert profile.c_prefixed_nonnegative_quantity_rows == 1
    assert profile.zero_price_rows == 1
    assert profile.negative_price_rows == 1
    assert profile.zero_quantity_rows == 1
    assert profile.nonintegral_quantity_rows == 1
    assert profile.invalid_or_nonfinite_quantity_rows == 2
    assert profile.invalid_or_nonfinite_price_rows == 2
    assert profile.invalid_or_missing_date_rows == 2
    assert profile.missing_by_column["InvoiceDate"] == 1
    assert profile.first_timestamp == "2011-06-14 09:30:00"


def test_profile_without_valid_values(raw):
    profile = profile_of(raw(line(Quantity="x", InvoiceDate="x")))
    assert profile.minimum_quantity is None
    assert profile.first_timestamp is None


def test_fingerprints(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_bytes(b"abc" * 1000)
    before = fingerprint(spark, str(path)).collect()
    assert before[0].sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
    assert before[0].length == 3000
    assert before[0].of_content
    large = fingerprint(spark, str(path), hashed_bytes=2999).first()
    assert (large.length, large.of_content) == (3000, False)
    kept = spark.createDataFrame(before)
    require_unchanged(kept, fingerprint(spark, str(path)))
    seen = spark.createDataFrame(listing(spark, str(path)).collect())
    path.write_bytes(b"abd" * 1001)
    assert changed_files(kept, fingerprint(spark, str(path))).count() == 1
    for old, take in ((kept, fingerprint), (seen, listing)):
        with pytest.raises(ValueError, match="changed during the run"):
            require_unchanged(old, take(spark, str(path)))
    with pytest.raises(FileNotFoundError, match="Input workbook not found"):
        fingerprint(spark, str(tmp_path / "absent"))


def test_a_third_of_all_lines_may_be_one_line(spark):
    """Copies meet before the shuffle: each task sends a hot line once."""
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        *[F.lit(DEFAULT[name]).alias(name) for name in RAW_COLUMNS[1:]],
        F.col("id").alias("source_row"),
    )
    hot = distinct_lines(frame).where("InvoiceNo = 'hot'").first()
    assert (hot.copies, hot.source_row) == (10_000, 0)
    plan = distinct_lines(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    assert eligible_lines(judge(frame)).count() == 20_001
