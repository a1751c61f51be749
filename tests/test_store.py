"""Stored judged lines are read by disposition, and ranks are taken by ranges."""

import random

import pytest

from conftest import line
from stallbook.operators import audit
from stallbook.operators.lines import eligible_lines, judge, stored_lines
from stallbook.operators.ranking import with_descending_ranks, with_positions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def judged(raw):
    return judge(raw(line(), line(StockCode="POST"), line(Quantity="0"), line(UnitPrice="-1"), line(Quantity="x")))


def test_readers_of_stored_lines_read_one_folder(judged):
    stored = stored_lines(judged)
    assert stored.columns == judged.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, judged.collect()))
    for wanted, disposition in ((eligible_lines(stored), "eligible"), (audit.excluded_entries(stored), "excluded_codes")):
        found = plan(wanted)
        filters = found[found.index("PartitionFilters: [") :].split("]")[0]
        assert f"= {disposition}" in filters
    assert eligible_lines(stored).count() == eligible_lines(judged).count() == 1
    assert audit.excluded_entries(stored).first().row_count == 1


def test_no_stored_line(judged):
    assert eligible_lines(stored_lines(judged.limit(0))).collect() == []


@pytest.mark.parametrize("ranges", [None, 1, 4, 30])
@pytest.mark.parametrize("values", [[0], [0, 0, 0, 5, None], list(range(40))])
def test_ranks_over_ranges(spark, ranges, values):
    draw = random.Random(len(values))
    rows = [(f"K{n:03d}", draw.choice(values), draw.choice(values)) for n in range(200)]
    table = spark.createDataFrame(rows, "code string, sold int, net int").repartition(3)
    found = with_descending_ranks(table, {"sold": "sold_rank", "net": "net_rank"}, "code", ranges)
    assert found.columns == ["code", "sold", "net", "sold_rank", "net_rank"]

    def place(value, column):
        if value is None:
            return 1 + sum(row[column] is not None for row in rows)
        return 1 + sum(row[column] is not None and row[column] > value for row in rows)

    got = {row.code: (row.sold_rank, row.net_rank) for row in found.collect()}
    assert got == {code: (place(sold, 1), place(net, 2)) for code, sold, net in rows}


@pytest.mark.parametrize("ranges", [None, 4, 30])
def test_positions_and_ranks_of_few_or_no_rows(spark, ranges):
    table = spark.createDataFrame([("b", 2), ("a", 2)], "code string, sold int")
    placed = with_positions(table, [("sold", True), ("code", False)], "at", ranges)
    assert sorted(map(tuple, placed.collect())) == [("a", 2, 1), ("b", 2, 2)]
    assert with_descending_ranks(table.limit(0), {"sold": "rank"}, "code", ranges).collect() == []
    assert with_positions(table.limit(0), [("code", False)], "at", ranges).collect() == []
