"""From raw lines to judged lines: one row for each distinct raw line.

A distinct line stands for all its copies. Every rule looks only at the eight
raw columns, so one shuffle serves deduplication, the audit of the removed
copies and the comparison with and without them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.functions import dates, numbers, text
from stallbook.schema import (
    CANCELLATION,
    EXCLUDED_CODES,
    OTHER_NEGATIVE,
    POSITIVE_SALE,
    RAW_COLUMNS,
)
from stallbook.storage import shares_of, written

COPIES = "copies"
COPY_KEY = "copy_key"
COPIES_AT_ONCE = 1 << 12
ELIGIBLE = "eligible"


def distinct_lines(raw: DataFrame) -> DataFrame:
    """Raw lines by all eight raw columns, nulls being equal: copies and first row.

    Copies are combined before the shuffle, so a line with very many of them
    travels as one row for each task.
    """
    measures = [F.count(F.lit(1)).alias(COPIES)]
    if "source_row" in raw.columns:
        measures.append(F.min("source_row").alias("source_row"))
    return raw.groupBy(*RAW_COLUMNS).agg(*measures)


def line_shares(raw: DataFrame) -> list[DataFrame]:
    """Stored raw lines in shares by a hash of the eight raw columns: all copies of a line are in one of them.

    Judging one share after the other shuffles no more than a share at once, and reads raw for each.
    """
    count = shares_of(raw.count())
    if count == 1:
        return [raw]
    share = F.pmod(F.xxhash64(*RAW_COLUMNS), F.lit(count))
    return [raw.where(share == each) for each in range(count)]


def is_excluded(code: Column) -> Column:
    return code.isin([excluded for excluded, _, _ in EXCLUDED_CODES])


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Add the parsed and normalised values; the raw columns stay as they are."""
    quantity, price = F.col("quantity_number"), F.col("price_number")
    return (
        lines.withColumns(
            {
                "invoice": text.identifier(F.col("InvoiceNo")),
                "code": text.identifier(F.col("StockCode")),
                "label": text.description(F.col("Description")),
                "buyer": text.customer(F.col("CustomerID")),
                "land": text.country(F.col("Country")),
                "missing": F.struct(*[F.col(name).isNull().alias(name) for name in RAW_COLUMNS]),
                "invoiced_at": dates.timestamp(F.col("InvoiceDate")),
                "quantity_number": numbers.number(F.col("Quantity")),
                "price_number": numbers.number(F.col("UnitPrice")),
                "quantity_exact": numbers.exact_quantity(F.col("Quantity")),
                "price_exact": numbers.exact_price(F.col("UnitPrice")),
                "cancels": text.is_cancellation(F.col("InvoiceNo")),
            }
        )
        .withColumns(
            {
                # Null but for the few numbers that are finer or larger than the exact columns.
                "quantity_beyond": numbers.beyond(F.col("Quantity"), quantity, F.col("quantity_exact")),
                "price_beyond": numbers.beyond(F.col("UnitPrice"), price, F.col("price_exact")),
            }
        )
        .withColumn("computable", numbers.is_finite(quantity) & numbers.is_finite(price))
        .withColumn(
            "signed_value",
            numbers.signed_value(
                F.col("computable"), F.col("quantity_exact"), F.col("price_exact"), quantity, price
            ),
        )
    )


def judged_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines with their disposition: the first rule that removes them, or eligible.

    Extra copies are removed by the first rule of all, which is why they are a
    count beside the line (copies - 1) and not a disposition.
    """
    quantity, price = F.col("quantity_number"), F.col("price_number")
    invalid = (
        (F.col("invoice") == "")
        | (F.col("code") == "")
        | F.col("invoiced_at").isNull()
        | ~F.col("computable")
        | numbers.is_fractional(quantity)
    )
    disposition = (
        F.when(is_excluded(F.col("code")), "excluded_codes")
        .when(invalid, "invalid_required_fields")
        .when(price < 0, "negative_prices")
        .when(price == 0, "zero_prices")
        .when(quantity == 0, "zero_quantities")
        .when(F.col("cancels") & (quantity > 0), "inconsistent_c_positive_quantity")
        .otherwise(ELIGIBLE)
    )
    return parsed_lines(lines).withColumn("disposition", disposition)


def category() -> Column:
    """What an eligible line is; null for a line that some rule removed."""
    quantity = F.col("quantity_number")
    return F.when(
        F.col("disposition") == ELIGIBLE,
        F.when(quantity > 0, POSITIVE_SALE)
        .when(F.col("cancels") & (quantity < 0), CANCELLATION)
        .otherwise(OTHER_NEGATIVE),
    )


def classified_lines(judged: DataFrame) -> DataFrame:
    """All judged lines, normalised, with signed value, category and copies.

    Reports on lines that are not stored take these as they are and let removed lines, which have no
    category, count for nothing. Filtering them out first would make Spark judge every raw line
    once more below the shuffle, and parse each one again for the filter alone.
    """
    kept = ["source_row"] if "source_row" in judged.columns else []
    return judged.select(
        F.col("invoice").alias("InvoiceNo"),
        F.col("code").alias("StockCode"),
        F.col("label").alias("Description"),
        numbers.at_source(F.col("quantity_exact"), F.col("quantity_beyond")).alias("Quantity"),
        F.col("invoiced_at").alias("InvoiceDate"),
        numbers.at_source(F.col("price_exact"), F.col("price_beyond")).alias("UnitPrice"),
        F.col("buyer").alias("CustomerID"),
        F.col("land").alias("Country"),
        *kept,
        F.col("signed_value").alias("signed_value_gbp"),
        category().alias("transaction_category"),
        COPIES,
    )


def for_lines(judged: DataFrame) -> DataFrame:
    """judged with the columns alone that classified_lines takes, for stores that nothing else is read from."""
    return judged.drop(*RAW_COLUMNS, "missing", "price_number", "computable")


def is_eligible() -> Column:
    return F.col("transaction_category").isNotNull()


def stored_lines(judged: DataFrame, name: str = "judged") -> DataFrame:
    """judged, written once in folders by disposition: who asks for some of them reads only theirs."""
    return written(judged, name, by="disposition")


def eligible_lines(judged: DataFrame) -> DataFrame:
    """Survivors of all rules.

    Of stored lines this reads one folder. Of others the filter goes below the shuffle of the distinct
    lines, where each copy is judged for it: store them first.
    """
    return classified_lines(judged.where(F.col("disposition") == ELIGIBLE))


def judge(raw: DataFrame) -> DataFrame:
    """Raw lines to judged distinct lines."""
    return judged_lines(distinct_lines(raw))


def line_key() -> Column:
    """128 bits that name a raw line. Each cell has its length before it, so no two lines are spelled alike."""
    cells = [
        F.coalesce(F.concat(F.length(cell).cast("string"), F.lit(":"), cell), F.lit("-")) for cell in map(F.col, RAW_COLUMNS)
    ]
    return F.unhex(F.md5(F.concat(*cells).cast("binary")))


def with_copy_key(judged: DataFrame) -> DataFrame:
    """judged, lines with copies also under the key that finds these copies again."""
    return judged.withColumn(COPY_KEY, F.when(F.col(COPIES) > 1, line_key()))


def unfolded(repeated: DataFrame) -> DataFrame:
    """Each line as often as it has copies.

    Lines with very many are first cut into runs of at most COPIES_AT_ONCE, which are spread over all tasks.
    """
    run, at = F.col("run"), F.lit(COPIES_AT_ONCE)
    runs = repeated.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col(COPIES) - 1) / at))))
    tasks = int(repeated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_run = F.least(at, F.col(COPIES) - run * at).cast("int")
    spread = runs.repartition(tasks, COPY_KEY, "run").withColumn("copy", F.explode(F.array_repeat(F.lit(True), of_run)))
    return spread.drop("run", "copy")


def every_copy(judged: DataFrame, raw: DataFrame) -> DataFrame:
    """Each raw line as a line of its own, as its distinct line was judged; judged is stored and has copy keys.

    A line without copies is already there. Without row numbers the copies of the others are all alike and
    come from their count. With them, of raw only the keys and row numbers are read for the others,
    and nothing is parsed again; raw is read a second time, so it should be stored, too. The repeated lines are the
    smaller side: with few of them no raw line is
    shuffled, and a line that makes up much of the data is a skewed key of raw alone, which adaptive
    execution splits.
    """
    repeated = judged.where(F.col(COPIES) > 1)
    if "source_row" in raw.columns:
        placed = raw.select(line_key().alias("key_of_copy"), "source_row")
        copies = repeated.drop("source_row").join(placed, F.col(COPY_KEY) == F.col("key_of_copy"))
    else:
        copies = unfolded(repeated)
    single = judged.where(F.col(COPIES) == 1)
    return single.unionByName(copies.select(*judged.columns)).drop(COPY_KEY).withColumn(COPIES, F.lit(1).cast("long"))
