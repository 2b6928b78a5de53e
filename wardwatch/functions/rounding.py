"""Exact half-up rounding of means.

``ROUND(AVG(x), n)`` on doubles rounds a binary approximation, and engines
disagree on ties (36.775 may print as 36.77 or 36.78). The mean of values
with a fixed number of decimals is a ratio of integers, so it is rounded
exactly in integer arithmetic instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _floor_div(num: Column, den: Column) -> Column:
    # exact for |num| < 2**53: the dividend is made a multiple of the divisor
    return ((num - F.pmod(num, den)) / den).cast("long")


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) half up, for num >= 0 and den > 0 (BIGINT); NULL if den is 0/NULL."""
    den = F.nullif(den, F.lit(0))
    return _floor_div(num * 2 + den, den * 2)


def rounded_mean(sum_units: Column, count: Column, unit_places: int, places: int) -> Column:
    """Mean rounded half up to ``places`` decimals, as DOUBLE.

    ``sum_units`` is the sum of the values scaled to integers with
    ``unit_places`` decimals (heart rate: 0, temperature in tenths: 1);
    ``count`` is the number of non-NULL values. Values must be >= 0.
    """
    if places < unit_places:
        raise ValueError("places must be >= unit_places")
    scale = 10 ** (places - unit_places)
    return half_up_div(sum_units * scale, count).cast("double") / (10 ** places)
