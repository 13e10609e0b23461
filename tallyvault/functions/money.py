"""Exact decimal helpers for money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _cent() -> Column:
    return F.lit(0.01).cast("decimal(3,2)")


def _milli() -> Column:
    return F.lit(0.001).cast("decimal(4,3)")


def one_rate() -> Column:
    return F.lit(1).cast("decimal(5,3)")


def cents_to_units(amount: Column) -> Column:
    """``ABS(amount) / 100`` kept exact: minor units -> decimal(22, 2)."""
    return F.abs(amount).cast("decimal(20,0)") * _cent()


def scale_rate(rate: Column) -> Column:
    """A missing exchange rate counts as 1 (the reference's COALESCE)."""
    return F.coalesce(rate, one_rate())


def floor_div(num: Column, den: Column) -> Column:
    """Exact floor(num / den) for non-negative integral decimals.

    Decimal division rounds its quotient at a fixed scale, so the floor of
    it can be one too high (or low) right at an integer boundary; one
    remainder test puts it right.
    """
    q = F.floor(num / den).cast("decimal(38,0)")
    r = num - q * den
    return F.when(r < 0, q - 1).when(r >= den, q + 1).otherwise(q)


def half_up_ratio(cents: Column, n: Column) -> Column:
    """round(cents / 100 / n, 3), half-up, exact: ((20c + n) div 2n) / 1000."""
    c = cents.cast("decimal(38,0)")
    nn = n.cast("decimal(20,0)")
    thousandths = floor_div(c * F.lit(20).cast("decimal(2,0)") + nn, nn * F.lit(2).cast("decimal(1,0)"))
    return (thousandths * _milli()).cast("decimal(18,3)")


def round_money(x: Column) -> Column:
    """ROUND(x, 3) into the mart's NUMERIC(18,3)."""
    return F.round(x, 3).cast("decimal(18,3)")
