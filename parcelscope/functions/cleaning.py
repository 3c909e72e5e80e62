"""Casts and flags for dirty source columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The payment types the marketplace accepts.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")

# The review scale.
MIN_SCORE, MAX_SCORE = 1, 5


def to_long(value: Column) -> Column:
    """Round half to even, then narrow to a whole number. Whole numbers pass through unchanged."""
    return F.bround(value).cast("long")


def safe_long(text: Column) -> Column:
    """A number read from text, or null where the text is not one."""
    return F.bround(F.trim(text).try_cast("double")).try_cast("long")


def score_valid(score: Column) -> Column:
    return F.when(score.between(MIN_SCORE, MAX_SCORE), 1).otherwise(0).cast("long")


def payment_type_valid(payment_type: Column) -> Column:
    return F.when(payment_type.isin(*PAYMENT_TYPES), 1).otherwise(0).cast("long")


def present(value: Column) -> Column:
    return value.isNotNull()


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0).cast("long")
