"""Raw ledger lines derived from an order database.

The orders are clean, so every kind of defect the rules deal with is planted
where a number computed from a line's keys (its mark, 0 to 999) says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.schema import EXCLUDED_CODES, RAW_COLUMNS
from stallbook.sources.numbering import number_repeated_rows, numbered_shares
from stallbook.storage import written

# What is read of each table; naming the types spares a look into the files.
TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_returnflag string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string",
}


def _mark() -> Column:
    return (
        F.col("l_orderkey") * 31
        + F.col("l_partkey") * 17
        + F.col("l_suppkey") * 7
        + F.col("l_linenumber") * 3
    ) % 1000


def _raw_text() -> list[Column]:
    """The eight raw columns; each key is turned to text once, whatever surrounds it."""
    mark, flag = F.col("mark"), F.col("l_returnflag")
    missing = F.lit(None).cast("string")
    returned = flag == "R"
    padded = returned & (mark % 10 == 7)

    before = F.when(padded, " c").when(returned | mark.between(64, 66), "C").otherwise("")
    after = F.when(padded, " ").otherwise("")
    invoice = F.when(
        mark != 50, F.concat(before, F.col("l_orderkey").cast("string"), after)
    ).otherwise(" ")

    excluded = F.array(*[F.lit(code) for code, _, _ in EXCLUDED_CODES])
    stock_code = (
        F.when(mark == 51, " ")
        .when(
            mark < 2 * len(EXCLUDED_CODES),
            F.element_at(excluded, (F.shiftright(mark, 1) + 1).cast("int")),
        )
        .otherwise(F.col("l_partkey").cast("string"))
    )
    ending = F.when(F.col("l_linenumber") % 3 == 0, " ALT").otherwise("")
    description = (
        F.when(mark.between(72, 79), missing)
        .when(mark.between(80, 89), "  ")
        .otherwise(F.concat(F.col("p_name"), ending))
    )
    negative = (returned & ~mark.between(64, 66)) | ((flag == "A") & (mark >= 900))
    quantity = (
        F.when(mark == 53, "bad")
        .when(mark == 54, "inf")
        .when(mark == 55, "1.5")
        .when(mark.between(62, 63), "0")
        .otherwise(
            F.concat(
                F.when(negative, "-").otherwise(""),
                F.col("l_quantity").cast("int").cast("string"),
            )
        )
    )
    date = F.when(mark == 52, "not a date").otherwise(
        F.substring(F.col("o_orderdate").cast("string"), 1, 19)
    )
    price = (
        F.col("l_extendedprice").cast("decimal(18,2)")
        + F.col("l_linenumber").cast("decimal(10,0)") * F.lit("0.001").cast("decimal(4,3)")
    ).cast("decimal(18,3)")
    unit_price = (
        F.when(mark == 56, missing)
        .when(mark == 57, "-inf")
        .when(mark.between(60, 61), "0")
        .otherwise(
            F.concat(F.when(mark.between(58, 59), "-").otherwise(""), price.cast("string"))
        )
    )
    customer = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", missing)
        .when(mark == 90, " ")
        .otherwise(F.col("o_custkey").cast("string"))
    )
    country = F.when(mark == 70, missing).when(mark == 71, " ").otherwise(F.col("n_name"))
    values = [
        invoice, stock_code, description, quantity, date, unit_price, customer, country,
    ]
    return [value.alias(name) for name, value in zip(RAW_COLUMNS, values)]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str, numbered: bool) -> DataFrame:
    """Order lines with their marks, and with their places when numbered is set; lines marked 40 to 49 come twice."""
    lines = _table(spark, folder, "lineitem")
    columns = [*lines.columns, _mark().alias("mark")]
    if numbered:
        columns += [
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.row_index").alias("row_index"),
        ]
    copies = F.when(F.col("mark").between(40, 49), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return lines.select(*columns).withColumn("copy", F.explode(copies))


def _placed(lines: DataFrame) -> tuple:
    return lines, F.col("file_path"), F.col("row_index"), F.col("copy")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders meet their customers before the far larger line table."""
    return (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "n_name")
    )


def _texts(lines: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Raw texts of lines; outer joins keep every line, so the numbers have no gaps."""
    number = ["source_row"] if "source_row" in lines.columns else []
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(*_raw_text(), *number)
    )


def raw_order_lines(spark: SparkSession, folder: str, numbered: bool = False) -> DataFrame:
    """The eight raw columns, and source_row in file order when numbered is set."""
    lines = _order_lines(spark, folder, numbered)
    if numbered:
        lines = number_repeated_rows(*_placed(lines))
    return _texts(lines, _orders(spark, folder), _table(spark, folder, "part"))


def raw_order_shares(spark: SparkSession, folder: str) -> list[DataFrame]:
    """raw_order_lines, numbered, in shares to be written one after the other; orders meet their customers once for all."""
    shares = numbered_shares(*_placed(_order_lines(spark, folder, numbered=True)))
    orders, part = _orders(spark, folder), _table(spark, folder, "part")
    if len(shares) > 1:
        orders = written(orders, "orders")
    return [_texts(lines, orders, part) for lines in shares]
