"""Numbers read from text, and the exact value of a line."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallbook.schema import PRICE, QUANTITY, SOURCE, VALUE

# The cast alone would also take Java spellings such as 5d, 5f or 0x1p3.
NUMBER_TEXT = (
    r"^[ \t\n\x0b\f\r]*"
    r"[+-]?(?:\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|(?i:inf|infinity))"
    r"[ \t\n\x0b\f\r]*$"
)

CAPACITY_ERROR = "Quantity times price is larger than the ledger can hold."

# Copies are multiplied in two limbs so that no product needs more than 38 digits.
LIMB = 100_000_000
WHOLE = 10**18


def number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def is_finite(value: Column) -> Column:
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))


def is_fractional(value: Column) -> Column:
    """True unless the value is a whole number; null counts as fractional."""
    return F.coalesce(value % 1 != 0, F.lit(True))


def exact_quantity(text: Column) -> Column:
    return text.try_cast(QUANTITY)


def exact_price(text: Column) -> Column:
    return text.try_cast(PRICE)


def beyond(text: Column, number: Column, narrow: Column) -> Column:
    """A finite number that its narrow decimal does not hold, to 18 decimals; null for all others."""
    held = F.coalesce(narrow.cast("double") == number, F.lit(False))
    return F.when(is_finite(number) & ~held, text.try_cast(SOURCE))


def at_source(narrow: Column, wide: Column) -> Column:
    """The number as it was read: what the narrow decimal does not hold is in the wide one."""
    return F.coalesce(wide, narrow.cast(SOURCE))


def signed_value(
    computable: Column, quantity: Column, price: Column, quantity_double: Column, price_double: Column
) -> Column:
    """Quantity x price, null when either is unusable; fails rather than overflowing.

    Exact where both numbers are held exactly. Numbers with more decimals, or too large for those
    columns, are multiplied as doubles; the product, below 10^28, is rounded to the nine decimals of a
    value, well within the tolerance of reconciliation.
    """
    held = (price.cast("double") == price_double) & (quantity.cast("double") == quantity_double)
    exact = F.try_multiply(quantity, price).cast(VALUE)
    product = F.when(held, exact).otherwise((quantity_double * price_double).try_cast(VALUE))
    return F.when(computable, F.coalesce(product, F.raise_error(CAPACITY_ERROR).cast(VALUE)))


def price_status(computable: Column, price: Column) -> Column:
    return (
        F.when(~computable, "invalid_numeric")
        .when(price > 0, "positive")
        .when(price == 0, "zero")
        .otherwise("negative")
    )


def times_copies(value: Column, copies: Column) -> Column:
    """Exact value x copies, however many copies a line has."""
    narrow = value.cast("decimal(28,9)")
    low = (narrow * (copies % LIMB).cast("decimal(8,0)")).cast(VALUE)
    high = (narrow * F.floor(copies / LIMB).cast("decimal(8,0)")).cast("decimal(28,9)")
    high = (high * F.lit(LIMB).cast("decimal(9,0)")).cast(VALUE)
    return (
        F.when(copies == 1, value.cast(VALUE))
        .when(copies == 0, F.lit(0).cast(VALUE))
        # So large a value is whole, as it comes from doubles, and a product with fewer decimals is exact.
        .when(F.abs(value) >= WHOLE, (value * copies.cast("decimal(19,0)")).cast(VALUE))
        .when(copies < LIMB, low)
        .otherwise((low + high).cast(VALUE))
    )
