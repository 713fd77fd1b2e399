"""Numeric and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parity(value: Column) -> Column:
    """``Even`` or ``Odd``; tests ``= 0`` only, as the remainder of a negative number is signed."""
    return F.when(value % 2 == 0, "Even").when(value.isNotNull(), "Odd")


def normal_or_attack(label: Column, normal: str = "normal.") -> Column:
    """``normal`` for the one normal label; everything else, null included, is ``attack``."""
    return F.when(label == normal, "normal").otherwise("attack")


def log_bucket(value: Column, per_decade: int = 1) -> Column:
    """Base-10 logarithmic bucket of a positive value, null otherwise."""
    return F.when(value > 0, F.floor(F.log10(value) * per_decade).cast("bigint"))


def finite(value: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(
        value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False)
    )
