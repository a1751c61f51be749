"""Source row numbers 2..n+1 (the header is row 1) without a global sort.

Rows are counted per bounded piece of the source; running sums over the pieces
give each piece its first number, and a row adds its place within the piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.storage import shares_of, written

FIRST_ROW = 2
BLOCK_ROWS = 1 << 16
# At a path of 200 characters, this many pieces are about 100 MB to broadcast.
BROADCAST_PIECES = 500_000
SPLIT_ERROR = "The input splits changed while rows were being numbered; run again."


def _starts(counted: DataFrame) -> DataFrame:
    """(file, piece, rows) -> rows before the piece, in file then piece order; the pieces are counted once and written."""
    return _starts_of(written(counted, "pieces"))


def _starts_of(pieces: DataFrame) -> DataFrame:
    """The starts of written pieces. Only the per-file totals meet in one task, one row for each input file."""
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        pieces.groupBy("file")
        .agg(F.sum("rows").alias("file_rows"))
        .select("file", F.coalesce(F.sum("file_rows").over(earlier), F.lit(0)).alias("file_start"))
    )
    inside = (
        Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = pieces.withColumn(
        "piece_start", F.coalesce(F.sum("rows").over(inside), F.lit(0))
    ).join(files, "file")
    # Few pieces spare the rows a shuffle; with more, Spark chooses the join.
    return F.broadcast(starts) if pieces.count() <= BROADCAST_PIECES else starts


def number_parquet_rows(df: DataFrame) -> DataFrame:
    """Rows of Parquet files know their index, so only files need counting."""
    columns = df.columns
    file = F.col("_metadata.file_path").alias("file")
    starts = _starts(
        df.select(file, F.lit(0).alias("piece"))
        .groupBy("file", "piece")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        df.select(*columns, file, F.col("_metadata.row_index").alias("row_index"))
        .join(starts, "file")
        .select(
            *columns, (F.col("file_start") + F.col("row_index") + FIRST_ROW).alias("source_row")
        )
    )


def number_text_rows(df: DataFrame) -> DataFrame:
    """Rows of text files are placed by input split and order within it."""
    columns = df.columns
    file = F.col("_metadata.file_path").alias("file")
    piece = F.col("_metadata.file_block_start").alias("piece")
    order = F.monotonically_increasing_id().alias("order")
    starts = _starts(
        df.select(file, piece, order)
        .groupBy("file", "piece")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("order").alias("first_order"))
    )
    place = F.col("order") - F.col("first_order")
    # A shifted or missing split would leave this range, so numbers are right or absent.
    inside = F.coalesce((place >= 0) & (place < F.col("rows")), F.lit(False))
    number = F.col("file_start") + F.col("piece_start") + place + FIRST_ROW
    return (
        df.select(*columns, file, piece, order)
        .join(starts, ["file", "piece"], "left")
        .select(
            *columns,
            F.when(inside, number)
            .otherwise(F.raise_error(SPLIT_ERROR).cast("bigint"))
            .alias("source_row"),
        )
    )


def number_repeated_rows(df: DataFrame, file: Column, index: Column, order: Column) -> DataFrame:
    """Number rows of which a source row may have given several, in (index, order) order.

    Blocks hold at most BLOCK_ROWS source rows whatever the data, so no task gets a hot one.
    """
    return _numbered_blocks(df, file, index, order)[0]


def numbered_shares(df: DataFrame, file: Column, index: Column, order: Column) -> list[DataFrame]:
    """The rows of number_repeated_rows in shares of whole blocks, so that no more than one has to be shuffled at once."""
    return _numbered_blocks(df, file, index, order, in_shares=True)


def _numbered_blocks(
    df: DataFrame, file: Column, index: Column, order: Column, in_shares: bool = False
) -> list[DataFrame]:
    columns = df.columns
    piece = F.floor(index / BLOCK_ROWS)
    placed = df.select(
        *columns, file.alias("file"), piece.alias("piece"), index.alias("index"), order.alias("order")
    )
    pieces = written(placed.groupBy("file", "piece").agg(F.count(F.lit(1)).alias("rows")), "pieces")
    starts = _starts_of(pieces)
    place = F.row_number().over(Window.partitionBy("file", "piece").orderBy("index", "order"))
    number = F.col("file_start") + F.col("piece_start") + F.col("place") - 1 + FIRST_ROW

    def numbered(rows: DataFrame) -> DataFrame:
        located = rows.withColumn("place", place).join(starts, ["file", "piece"])
        return located.select(*columns, number.alias("source_row"))

    count = shares_of(pieces.agg(F.sum("rows")).first()[0] or 0) if in_shares else 1
    if count == 1:
        return [numbered(placed)]
    share = F.pmod(F.xxhash64("file", "piece"), F.lit(count))
    return [numbered(placed.where(share == each)) for each in range(count)]


def number_frame_rows(df: DataFrame) -> DataFrame:
    """Number any other DataFrame in partition order, on a written copy of it."""
    columns = df.columns
    placed = written(
        df.select(
            *columns,
            F.spark_partition_id().alias("piece"),
            F.monotonically_increasing_id().alias("order"),
        ),
        "numbered",
    ).withColumn("file", F.lit(""))
    starts = _starts(
        placed.groupBy("file", "piece").agg(
            F.count(F.lit(1)).alias("rows"), F.min("order").alias("first_order")
        )
    )
    return placed.join(starts, ["file", "piece"]).select(
        *columns,
        (F.col("piece_start") + F.col("order") - F.col("first_order") + FIRST_ROW).alias(
            "source_row"
        ),
    )
