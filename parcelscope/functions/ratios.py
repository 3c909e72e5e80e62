"""Division and blanks the way the report layer reads them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_if_zero(count: Column) -> Column:
    """A filtered count over no rows is blank, not zero."""
    return F.nullif(count, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when either side is null or the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
