"""Rounding that goes through integers, so that it does not depend on binary fractions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tenths(rating: Column) -> Column:
    """A rating as a whole number of tenths."""
    return F.round(rating.cast("double") * 10).cast("bigint")


def average_from_tenths(total: Column, count: Column) -> Column:
    """Average with one decimal, halves up, from a sum of tenths; null for no rows."""
    return F.when(count > 0, _div(2 * total + count, 2 * count) / F.lit(10).cast("double"))


def whole_percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` without decimals, halves up; null for a zero whole."""
    return F.when(whole > 0, _div(200 * part + whole, 2 * whole))


def _div(a: Column, b: Column) -> Column:
    # A guard around the division: expressions are also evaluated for rows a filter drops.
    return F.call_function("div", a.cast("bigint"), F.nullif(b.cast("bigint"), F.lit(0).cast("bigint")))
