"""Numeric helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding goes through a decimal so that ties round half up on the decimal
# value people read (1.005 -> 1.01), identically in every SQL engine; rounding
# the binary double directly differs between engines on such ties.
_ROUND_DECIMAL = "decimal(38,8)"


def round_half_up(col: Column | str, scale: int = 2) -> Column:
    """Half-up on the decimal value; infinite and other doubles beyond the
    decimal's range have no digits to round and stay as they are."""
    c = F.col(col) if isinstance(col, str) else col
    d = c.cast("double")
    return F.when(F.abs(d) >= F.lit(1e29), d).otherwise(F.round(c.try_cast(_ROUND_DECIMAL), scale).cast("double"))


def r2(col: Column | str) -> Column:
    return round_half_up(col, 2)


def r4(col: Column | str) -> Column:
    return round_half_up(col, 4)


def safe_div(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL (T-SQL NULLIF(den, 0))."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def percent(num: Column, den: Column) -> Column:
    """100.0 * num / den as double, NULL on a zero denominator."""
    return safe_div(F.lit(100.0) * num.cast("double"), den)
