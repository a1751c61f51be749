"""Large tables are written and judged in shares, and nothing that a share shuffled outlives it."""

import datetime
import time
from decimal import Decimal

import pytest
from conftest import RAW_TYPES, line
from pyspark.sql import functions as F

from stallbook import storage
from stallbook.catalog import queries
from stallbook.operators import controls
from stallbook.operators.lines import line_shares
from stallbook.plans.analysis import build_tables, clean, compare_controls
from stallbook.schema import RAW_COLUMNS
from stallbook.sources import numbering
from stallbook.sources.files import RawLedger
from stallbook.sources.order_lines import TABLES, raw_order_lines, raw_order_shares
from stallbook.storage import FREEING, written_in_shares


def shuffled(spark):
    """Bytes of the shuffle files that lie on the disk, by name."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    sizes = {}
    while files.hasNext():
        file = files.next()
        sizes[file.getName()] = file.length()
    return {name: size for name, size in sizes.items() if name.startswith("shuffle_") and name.endswith(".data")}


def left(spark, before, patience=20):
    """The shuffle files since before; Spark removes files a little after it says so."""
    for _ in range(patience):
        found = {name: size for name, size in shuffled(spark).items() if name not in before}
        if not found:
            break
        time.sleep(0.1)
    return found


def text_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def order_tables(spark, tmp_path):
    """Own order tables of 300 lines in three files, with keys that are null, unknown or there twice."""
    folder, day = str(tmp_path), datetime.datetime(2001, 3, 4, 5, 6, 7)
    keys = [None, *range(40), 7]
    rows = {
        "lineitem": [
            (None if n % 41 == 0 else n % 45, n % 13, n % 7, n % 4, float(n % 50), n * 1.25, "NRA"[n % 3]) for n in range(300)
        ],
        "orders": [(key, key and key % 9, day, "4-NOT SPECIFIED" if key == 3 else "1-URGENT") for key in keys],
        "customer": [(key, key and key % 3) for key in [None, *range(8), 2]],
        "nation": [(0, "NATION_0"), (1, "NATION_1"), (None, "NOWHERE")],
        "part": [(key, f"part {key}") for key in [None, *range(12), 5]],
    }
    for name, values in rows.items():
        table = spark.createDataFrame(values, TABLES[name]).coalesce(1)
        table.write.option("maxRecordsPerFile", 110).parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture
def small_shares(monkeypatch):
    monkeypatch.setattr(storage, "SHARE_ROWS", 60)
    monkeypatch.setattr(numbering, "BLOCK_ROWS", 16)


def test_written_shares_are_one_table_without_shuffles(spark):
    before = shuffled(spark)
    shares = [spark.range(20).groupBy((F.col("id") % 4).alias("key")).agg(F.sum("id").alias("total")).where(f"key % 2 = {n}") for n in (0, 1)]
    table = written_in_shares(shares, "shares", by="key")
    assert sorted(map(tuple, table.collect())) == [(0, 40), (1, 45), (2, 50), (3, 55)]
    assert left(spark, before) == {}
    assert spark.conf.get(FREEING, None) is None


@pytest.mark.parametrize("chosen", ["true", "false"])
def test_a_chosen_way_to_free_shuffles_is_kept(spark, chosen):
    spark.conf.set(FREEING, chosen)
    try:
        written_in_shares([spark.range(3)], "kept")
        assert spark.conf.get(FREEING) == chosen
    finally:
        spark.conf.unset(FREEING)


def test_the_session_is_left_as_it_was_when_a_share_fails(spark):
    with pytest.raises(Exception, match="broken"):
        written_in_shares([spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("n"))], "broken")
    assert spark.conf.get(FREEING, None) is None


def test_blocks_are_numbered_alike_in_shares(spark, order_tables, small_shares):
    whole = raw_order_lines(spark, order_tables, numbered=True)
    shares = raw_order_shares(spark, order_tables)
    assert len(shares) > 3
    assert text_rows(written_in_shares(shares, "raw")) == text_rows(whole)
    starts = [share.agg(F.count("*"), F.count_distinct("source_row")).first() for share in shares]
    assert max(rows for rows, _ in starts) < whole.count() / 2


def test_copies_meet_in_one_share(spark, small_shares):
    lines = [line(InvoiceNo=f"{n % 90}", Country=None if n % 2 else "Norway", Description=None) for n in range(270)]
    raw = spark.createDataFrame(lines, RAW_TYPES)
    shares = [sorted(map(str, share.collect())) for share in line_shares(raw)]
    assert len(shares) == 5 and sorted(sum(shares, [])) == text_rows(raw)
    assert sum(len(set(share)) for share in shares) == len(set(sum(shares, []))) == 90


def test_totals_of_shares_are_added_exactly():
    large, small = Decimal("9" * 28 + ".999999999"), Decimal("0.000000001")
    assert controls._added([{"a": large}, {"a": small}, {"a": -small}]) == {"a": large}


@pytest.mark.parametrize("remove_duplicates", [True, False])
def test_lines_judged_in_shares_make_the_same_tables(spark, monkeypatch, remove_duplicates):
    kinds = [line(), line(StockCode="POST"), line(InvoiceNo="C8", Quantity="-1"), line(Country=None, CustomerID=None)]
    rows = [(*row, number) for number, row in enumerate(kinds * 3, 2)]
    raw = spark.createDataFrame(rows, f"{RAW_TYPES}, source_row bigint")

    def run(stored):
        whole = clean(RawLedger(raw, RAW_COLUMNS, stored=stored), remove_duplicates)
        tables = build_tables(whole)
        checked = compare_controls(whole, tables)
        assert checked.where("not ok").collect() == []
        return [text_rows(checked), *[text_rows(tables[name]) for name in sorted(tables)]]

    at_once = run(stored=False)
    # Six shares of four different lines, so that some are empty.
    monkeypatch.setattr(storage, "SHARE_ROWS", 2)
    assert run(stored=True) == at_once


@pytest.mark.parametrize("share_rows", [60, 80 << 20])
def test_control_totals_keep_no_shuffle_of_raw_or_judged_lines(spark, order_tables, monkeypatch, share_rows):
    """What lies there when the tables are built is of counts of blocks and of the audit, and not of some 300 lines."""
    monkeypatch.setattr(storage, "SHARE_ROWS", share_rows)
    monkeypatch.setattr(numbering, "BLOCK_ROWS", 16 if share_rows == 60 else 1 << 16)
    before, kept = shuffled(spark), []
    monkeypatch.setattr(queries, "build_tables", lambda *_: kept.append(left(spark, before)))
    monkeypatch.setattr(queries, "compare_controls", lambda cleaned, _: cleaned.controls)
    assert queries.control_totals(spark, order_tables).first().raw_rows == raw_order_lines(spark, order_tables).count()
    assert sum(kept[0].values()) < 6000, kept
