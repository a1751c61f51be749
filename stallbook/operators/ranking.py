"""Exact global ranks, with no task that holds more than a range of the rows.

Both start from a range partitioning whose last sort column is unique, so rows of equal value are cut into
several ranges like any others. All that is gathered is one row for each range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.storage import written


def _ordering(column: str, descending: bool):
    return F.col(column).desc() if descending else F.col(column).asc()


def _in_ranges(df: DataFrame, order: list, ranges: int | None) -> DataFrame:
    """df parted by order, into as many ranges as Spark sees fit or as given, with the number of each row's."""
    parted = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return parted.sortWithinPartitions(*order).withColumn("partition", F.spark_partition_id())


def _with_earlier(counted: DataFrame) -> DataFrame:
    """The rows in all earlier ranges, beside each range with its number of rows."""
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("earlier", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def with_positions(
    table: DataFrame, order: list[tuple[str, bool]], name: str, ranges: int | None = None
) -> DataFrame:
    """Add positions 1..n in (column, descending) order; the order must be unique."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordering = [_ordering(*part) for part in order]
    placed = written(_in_ranges(table, ordering, ranges).withColumn("place", place), "placed")
    earlier = _with_earlier(placed.groupBy("partition").agg(F.count(F.lit(1)).alias("rows")))
    return placed.join(F.broadcast(earlier), "partition").select(
        *table.columns, (F.col("earlier") + F.col("place") + 1).cast("bigint").alias(name)
    )


def _ranked(table: DataFrame, value: str, key: str, rank: str, ranges: int | None) -> DataFrame:
    within = Window.partitionBy("partition").orderBy(F.col(value).desc())
    ranked = written(
        _in_ranges(table, [F.col(value).desc(), F.col(key)], ranges).withColumn("within", F.rank().over(within)),
        "ranked",
    )
    ends = _with_earlier(
        ranked.groupBy("partition").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min_by(value, "within").alias("top"),
            F.max_by(value, "within").alias("bottom"),
            F.max("within").alias("bottom_within"),
        )
    )
    # A value at the top of a range may have begun in an earlier one, at whose bottom it then is.
    begun = ends.groupBy(F.col("bottom").alias("value")).agg(
        F.min(F.col("earlier") + F.col("bottom_within") - 1).alias("begun")
    )
    starts = ends.join(F.broadcast(begun), F.col("top").eqNullSafe(F.col("value")), "left").select(
        "partition", "earlier", "top", F.coalesce("begun", "earlier").alias("begun")
    )
    larger = F.when(F.col(value).eqNullSafe(F.col("top")), F.col("begun")).otherwise(
        F.col("earlier") + F.col("within") - 1
    )
    return ranked.join(F.broadcast(starts), "partition").select(
        *table.columns, (larger + 1).cast("bigint").alias(rank)
    )


def with_descending_ranks(
    table: DataFrame, ranks: dict[str, str], key: str | int | None = None, ranges: int | None = None
) -> DataFrame:
    """Add minimum ranks (1, 1, 3), largest value first: {value column: rank column}.

    key is unique; without one, the first column is taken, and the number of ranges may come in its place. Nulls come
    last and are equal to each other.
    """
    if isinstance(key, int):
        key, ranges = None, key
    key = key or table.columns[0]
    for value, rank in ranks.items():
        table = _ranked(table, value, key, rank, ranges)
    return table
