"""Exact selection of one value by rank, without sorting.

Each round is one aggregate: the values still in question are counted in
``BINS`` bins, each with its least and greatest value, and the bin that holds
the wanted rank is the range of the next round.  At most ``BINS`` rows come to
the driver in a round.  Bins are even on a logarithmic scale in the first round, so
that a few wild values don't leave all others in one bin, and even in the later ones.
The two ends of a range have bins of their own, so every round narrows it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024


def _log_scale(x: Column) -> Column:
    return F.signum(x) * F.log1p(F.abs(x))


def value_at(df: DataFrame, column: str, rank: Callable[[int], int]) -> float | None:
    """The value with the given rank (from 1, ascending) among the non-null, non-NaN values; None if there is none.

    ``rank`` gets the number of values.  ``df`` is read once a round, two to
    four times for ordinary figures, so it should be a stored frame.
    """
    value = F.col(column).cast("double")
    v = F.col("_v")
    rows = df.select(value.alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    n, low, high = rows.agg(F.count(v), F.min(v), F.max(v)).first()
    k = rank(n)
    if not 1 <= k <= n:
        return None
    scale = _log_scale
    while low < high:
        first, last = F.lit(low), F.lit(high)
        # the scales and all steps never fall, so bins are ranges of values
        part = (scale(v) - scale(first)) / (scale(last) - scale(first))
        inner = F.least(F.greatest(F.floor(F.nanvl(part, F.lit(0.0)) * (BINS - 2)) + 1, F.lit(1)), F.lit(BINS - 2))
        place = F.when(v == first, 0).when(v == last, BINS - 1).otherwise(inner)
        bins = rows.where(v.between(first, last)).groupBy(place.alias("bin")).agg(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"))
        for b in sorted(bins.collect()):
            if k <= b.n:
                low, high = b.low, b.high
                break
            k -= b.n
        scale = lambda x: x
    return low
