"""Numeric expressions shared by every metric."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rnd(value: Column, digits: int) -> Column:
    """Half-up rounding through DECIMAL, so binary noise cannot move a tie."""
    return F.round(value.try_cast("decimal(28,10)"), digits).cast("double")


def rsum(name: str, digits: int = 2) -> Column:
    return rnd(F.sum(name), digits)


def ravg(name: str, digits: int = 2) -> Column:
    return rnd(F.avg(name), digits)


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating division; null where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean_power() -> Column:
    """Average power of one stop row. The reported power is 0 at stop, so it comes from energy over time."""
    return ratio(F.col("energy_kwh"), F.col("duration_minutes") / F.lit(60.0))
