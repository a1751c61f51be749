"""Column contract, fixed values and settings of the ledger."""

from __future__ import annotations

from dataclasses import dataclass

# The required raw columns, in duplicate-key order.
RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

# Stock codes that are not merchandise (code, category, reason).
EXCLUDED_CODES = [
    ("POST", "delivery", "POSTAGE"),
    ("DOT", "delivery", "DOTCOM POSTAGE"),
    ("C2", "delivery", "CARRIAGE"),
    ("23444", "delivery", "Next Day Carriage"),
    ("BANK CHARGES", "fee", "Bank Charges"),
    ("AMAZONFEE", "fee", "AMAZON FEE"),
    ("CRUK", "fee", "CRUK Commission"),
    ("D", "discount", "Discount adjustment"),
    ("B", "accounting_adjustment", "Adjust bad debt"),
    ("gift_0001_10", "voucher", "£10 gift voucher"),
    ("gift_0001_20", "voucher", "£20 gift voucher"),
    ("gift_0001_30", "voucher", "£30 gift voucher"),
    ("gift_0001_40", "voucher", "£40 gift voucher"),
    ("gift_0001_50", "voucher", "£50 gift voucher"),
    ("22016", "voucher", "£100 gift voucher"),
    ("M", "manual", "Manual; underlying product/activity unclear"),
    ("m", "manual", "Manual; underlying product/activity unclear"),
    ("S", "samples", "Samples; code does not identify a specific product"),
]

# The removal rules in the order they are applied.
REMOVAL_STEPS = [
    "exact_duplicates",
    "excluded_codes",
    "invalid_required_fields",
    "negative_prices",
    "zero_prices",
    "zero_quantities",
    "inconsistent_c_positive_quantity",
]

# What an eligible line can be.
POSITIVE_SALE = "positive_sale"
CANCELLATION = "cancellation"
OTHER_NEGATIVE = "other_negative"
CATEGORIES = [POSITIVE_SALE, CANCELLATION, OTHER_NEGATIVE]

# The money columns of every table.
VALUE_COLUMNS = [
    "positive_sales_gbp",
    "cancellation_value_gbp",
    "other_negative_value_gbp",
    "net_value_gbp",
]

# The measures of the audit.
AUDIT_COLUMNS = [
    "signed_value_positive_price_gbp",
    "signed_value_nonpositive_price_gbp",
    "uncomputable_value_count",
]

# Money is exact: quantity x price fits VALUE, and any sum of it fits MONEY.
# Quantities and prices are as wide as decimals kept in a long can be.
QUANTITY = "decimal(18,3)"
PRICE = "decimal(18,6)"
VALUE = "decimal(37,9)"
MONEY = "decimal(38,9)"
# Quantities and prices as they were read.
SOURCE = "decimal(38,18)"


@dataclass(frozen=True)
class Settings:
    """What depends on the data set rather than on the rules."""

    partial_months: tuple[str, ...] = ("2011-12",)
    home_country: str = "United Kingdom"
    top: int = 10


def missing_columns(columns: list[str]) -> list[str]:
    return [name for name in RAW_COLUMNS if name not in columns]


def require_columns(columns: list[str]) -> None:
    """Fail with the names of absent columns; additional columns are fine."""
    absent = missing_columns(columns)
    if absent:
        raise ValueError("Missing required columns: " + ", ".join(absent))
