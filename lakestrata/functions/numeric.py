"""Numeric helpers with the reference's NULL-on-zero semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """NULL when the denominator is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def nullif0(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


#: From here on doubles have no digits that rounding to cents could change.
WHOLE_FROM = 1e15


def round_column(name: str, scale: int) -> Column:
    """:func:`round_half_up` of a double column, built as one expression: plans
    with many of them are made faster."""
    c = f"`{name}`"
    return F.expr(f"CASE WHEN abs({c}) >= {WHOLE_FROM}D THEN CAST({c} AS DOUBLE) ELSE CAST(round(try_cast({c} AS DECIMAL(38,10)), {scale}) AS DOUBLE) END")


def round_half_up(c: Column, scale: int) -> Column:
    """Round a double half away from zero on its decimal value.

    The value is first fixed to 10 decimals so that summation-order noise
    (``1.0149999999999997`` vs ``1.0150000000000001``) cannot flip a tie.
    Values of 1e15 and more, infinities and NaN stay as they are.
    """
    whole = F.abs(c) >= F.lit(WHOLE_FROM)  # also true for NaN, the largest double
    return F.when(whole, c.cast("double")).otherwise(F.round(c.try_cast("decimal(38,10)"), scale).cast("double"))
