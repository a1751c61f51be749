"""Rejected rows, folders recognised by their files, and instants in a declared zone."""

import datetime as dt
import gzip

import pytest
from conftest import line

from stallbook.operators.lines import judge
from stallbook.plans.job import run_analysis
from stallbook.schema import RAW_COLUMNS
from stallbook.sources.files import read_csv, read_ledger

HEADER = ",".join(RAW_COLUMNS) + "\n"
GOOD = ",".join(line()) + "\n"
SHORT, LONG = "9001,HAT,Hat\n", ",".join(line(StockCode="HAT")) + ",more,cells\n"


def test_rows_with_too_few_or_too_many_cells_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + GOOD + SHORT + GOOD + LONG)
    (tmp_path / "b.csv").write_text(HEADER + LONG + ",".join(f'"{cell}"' for cell in line(Description="a, b")) + "\n")
    ledger = read_ledger(spark, str(tmp_path))
    assert sorted(row.source_row for row in ledger.lines.collect()) == [2, 4, 7]
    assert {row.Description for row in ledger.lines.collect()} == {"Blue teapot", "a, b"}
    rejected = sorted((row.source_row, row.source_file.rsplit("/", 1)[1], row.record) for row in ledger.rejects.collect())
    assert rejected == [(3, "a.csv", SHORT.strip()), (5, "a.csv", LONG.strip()), (6, "b.csv", LONG.strip())]
    assert ledger.column_names == RAW_COLUMNS


def test_rejected_rows_are_published(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0.csv").write_text(HEADER + GOOD + SHORT)
    run_analysis(spark, f"{tmp_path}/in", f"{tmp_path}/out", hash_content=False)
    assert [row.record for row in spark.read.parquet(f"{tmp_path}/out/rejected_rows").collect()] == [SHORT.strip()]
    assert spark.read.parquet(f"{tmp_path}/out/eligible_lines").count() == 1


def test_lines_with_breaks_need_multi_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + GOOD.replace("Blue teapot", '"Blue\nteapot"'))
    assert read_csv(spark, str(tmp_path), multi_line=True).lines.first().Description == "Blue\nteapot"
    split = read_ledger(spark, str(tmp_path))
    assert split.lines.count() == 0 and split.rejects.count() == 2


def test_folders_are_recognised_by_their_files(spark, tmp_path):
    packed, typed, mixed, none = (tmp_path / name for name in ("packed", "typed", "mixed", "none"))
    packed.mkdir()
    (packed / "a.csv.gz").write_bytes(gzip.compress((HEADER + GOOD).encode()))
    spark.createDataFrame([line()], RAW_COLUMNS).write.parquet(str(typed))
    spark.createDataFrame([line()], RAW_COLUMNS).write.parquet(str(mixed))
    (mixed / "a.csv").write_text(HEADER + GOOD)
    none.mkdir()
    (none / "notes.txt").write_text("no ledger")
    for path in (packed, typed):
        assert [tuple(row)[:8] for row in read_ledger(spark, str(path)).lines.collect()] == [line()]
    for path in (mixed, none):
        with pytest.raises(ValueError, match="name the form"):
            read_ledger(spark, str(path))
    with pytest.raises(ValueError, match="no form of a ledger"):
        read_ledger(spark, str(typed), form="xlsx")
    with pytest.raises(FileNotFoundError):
        read_ledger(spark, str(tmp_path / "absent"))


def test_instants_have_one_month_whatever_the_session_zone(spark, tmp_path):
    rows = [(*line(InvoiceNo=str(k)), moment) for k, moment in enumerate(
        [dt.datetime(2011, 6, 30, 22, 30, tzinfo=dt.timezone.utc), dt.datetime(2011, 10, 30, 0, 30, 0, 250_000, tzinfo=dt.timezone.utc), dt.datetime(1969, 12, 31, 23, 59, 59, tzinfo=dt.timezone.utc)]
    )]
    frame = spark.createDataFrame(rows, ", ".join([*[f"{name} string" for name in RAW_COLUMNS], "moment timestamp"]))
    frame.drop("InvoiceDate").withColumnRenamed("moment", "InvoiceDate").write.parquet(str(tmp_path / "typed"))
    kept, seen = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        for session in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            for zone, months in (("UTC", ("2011-06", "2011-10", "1969-12")), ("Europe/Paris", ("2011-07", "2011-10", "1970-01"))):
                judged = judge(read_ledger(spark, str(tmp_path / "typed"), time_zone=zone).lines).orderBy("invoice").collect()
                assert tuple(str(row.invoiced_at)[:7] for row in judged) == months
                seen.add((zone, tuple(str(row.invoiced_at) for row in judged)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert len(seen) == 2 and any("2011-10-30 02:30:00.250000" in moments for _, moments in seen)
