"""Text normalisation of identifiers and labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "    　"
)


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (plain trim only knows U+0020)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def identifier(text: Column) -> Column:
    """Invoice and stock code: stripped, absent becomes the empty text."""
    return F.coalesce(strip(text), F.lit(""))


def description(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def customer(text: Column) -> Column:
    """Blank customers are unknown, so they become null."""
    return F.nullif(strip(text), F.lit(""))


def country(text: Column) -> Column:
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit("Unknown"))


def is_cancellation(invoice: Column) -> Column:
    """The invoice starts with C in either case; null is not a cancellation."""
    return F.coalesce(F.startswith(F.upper(strip(invoice)), F.lit("C")), F.lit(False))


def number_as_identifier(number: Column) -> Column:
    """A numeric identifier: integral numbers lose their fraction, NaN is null."""
    whole = number.try_cast("decimal(38,0)")
    return F.when(~F.isnan(number), F.when(
        (number == F.floor(number)) & whole.isNotNull(), whole.cast("string")
    ).otherwise(number.cast("string")))
