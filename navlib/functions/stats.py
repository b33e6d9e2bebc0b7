"""Statistical and display-rounding column expressions (all JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trading-day counts used to scale a daily standard deviation.
TRADING_DAYS_YEAR = 252
TRADING_DAYS_MONTH = 21
TRADING_DAYS_WEEK = 5
# Calendar days per year used to annualise period returns.
CALENDAR_DAYS_YEAR = 365.25


def sqrt_days(days: int) -> float:
    return math.sqrt(days)


ANNUAL_SQRT = sqrt_days(TRADING_DAYS_YEAR)


def half_up(col: Column | str, digits: int) -> Column:
    """Round to ``digits`` places on the scaled binary value, halves away from zero.

    ``round(x * 10^d) / 10^d``: the same result as the display rounding of the
    reports (and as DuckDB's ``ROUND``), which differs from Spark's decimal
    ``round`` on values such as 316.335.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def bias_corrected_skewness(x: Column | str) -> Column:
    """Aggregate: adjusted Fisher-Pearson skewness G1 (sample form).

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    A constant series gives 0; fewer than 3 values give NULL.
    """
    c = F.col(x) if isinstance(x, str) else x
    return sample_skewness(F.count(c), F.skewness(c), F.stddev_pop(c) == 0)


def sample_skewness(count: Column, g1: Column, constant: Column) -> Column:
    """G1 from the number of values and their population skewness."""
    n = count.cast("double")
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(constant, F.lit(0.0))
        .otherwise(F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2))
    )


def bias_corrected_kurtosis(x: Column | str) -> Column:
    """Aggregate: sample excess kurtosis G2.

    Spark's ``kurtosis`` is the population excess g2;
    G2 = (n-1) / ((n-2)(n-3)) * ((n+1) g2 + 6).  Constant series give 0,
    fewer than 4 values give NULL.
    """
    c = F.col(x) if isinstance(x, str) else x
    return excess_kurtosis(F.count(c), F.kurtosis(c), F.stddev_pop(c) == 0)


def excess_kurtosis(count: Column, g2: Column, constant: Column) -> Column:
    """G2 from the number of values and their population excess kurtosis."""
    n = count.cast("double")
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(constant, F.lit(0.0))
        .otherwise(F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def growth_percent(col: Column | str) -> Column:
    """Round an annualised percentage: 2 places, and above a million to nine digits.

    Values that large come from extrapolating a few days to a year; the two
    ``pow`` of Java and C differ in their last bits there, which no digit
    shown may depend on.
    """
    c = F.col(col) if isinstance(col, str) else col
    unit = F.concat(F.lit("1e"), F.floor(F.log10(F.abs(c)) - 8).cast("string")).cast("double")
    return F.when(F.abs(c) < 1e6, half_up(c, 2)).otherwise(F.round(F.try_divide(c, unit), 0) * unit)
