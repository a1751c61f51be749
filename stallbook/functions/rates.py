"""Percentages."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """100 x part / whole as double; null for a zero whole, never capped."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
