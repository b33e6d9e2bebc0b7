"""Anomaly detection over every scheme (OP45-OP49).

The analysed rows are the daily returns with each scheme's first row (no
return) removed, as the report defines; jumps and unchanged runs are
measured between consecutive *analysed* rows, so a scheme's first move is
never reported.  Extreme returns use the mean and sd pooled over all
analysed rows, read through scalar subqueries (no join).  Nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.functions.stats import half_up
from navlib.operators.returns import daily_returns

KEY = "scheme_code"

# Detector thresholds of the anomaly report.
DEFAULT_STD_THRESHOLD = 3.0
JUMP_THRESHOLD = 0.20
DATA_ERROR_THRESHOLD = 0.50
STALE_MIN_RUN = 5
NAV_MIN_EXCLUSIVE = 0
NAV_MAX_INCLUSIVE = 10000
MIN_DATA_POINTS = 50


def _series() -> Window:
    return Window.partitionBy(KEY).orderBy("date")


def analysed_rows(nav: DataFrame, min_data_points: int = MIN_DATA_POINTS) -> DataFrame:
    """Return rows analysed by the detectors; empty when ``nav`` has fewer than ``min_data_points`` rows."""
    total = nav.select(F.count(F.lit(1))).scalar()
    rows = daily_returns(nav).where(F.col("r").isNotNull() & F.col("scheme_name").isNotNull())
    return rows.where(total >= min_data_points)


def _with_moves(rows: DataFrame) -> DataFrame:
    prev = F.lag("nav").over(_series())
    return rows.withColumn("_change", F.col("nav") - prev).withColumn("_change_pct", F.try_divide(F.col("_change"), prev))


def _pooled(rows: DataFrame) -> tuple[Column, Column]:
    """Pooled mean and sample sd of r: one scalar subquery, run once."""
    stats = rows.select(F.struct(F.avg("r").alias("m"), F.stddev_samp("r").alias("s"))).scalar()
    return stats.getField("m"), stats.getField("s")


def _is_extreme(mean: Column, sd: Column, k: float) -> Column:
    r = F.col("r")
    return (r > mean + F.lit(k) * sd) | (r < mean - F.lit(k) * sd)


def _is_jump(threshold: float) -> Column:
    return F.abs(F.col("_change_pct")) > threshold


def _is_invalid() -> Column:
    return (F.col("nav") <= NAV_MIN_EXCLUSIVE) | (F.col("nav") > NAV_MAX_INCLUSIVE)


def _rows(nav: DataFrame, min_data_points: int, rows: DataFrame | None) -> DataFrame:
    """``rows`` (output of ``analysed_rows``, e.g. checkpointed by a report) or computed from ``nav``."""
    return rows if rows is not None else analysed_rows(nav, min_data_points)


def extreme_returns(
    nav: DataFrame,
    threshold_std: float = DEFAULT_STD_THRESHOLD,
    min_data_points: int = MIN_DATA_POINTS,
    rows: DataFrame | None = None,
    scope: str = "pooled",
) -> DataFrame:
    """OP45: returns further than ``threshold_std`` sds from the mean.

    ``scope="pooled"`` takes mean and sd of all analysed returns, ``"scheme"``
    those of each scheme (in the partitioning that the returns already have).
    """
    rows = _rows(nav, min_data_points, rows)
    if scope == "pooled":
        mean, sd = _pooled(rows)
    elif scope == "scheme":
        own = Window.partitionBy(KEY)
        rows = rows.withColumn("_m", F.avg("r").over(own)).withColumn("_s", F.stddev_samp("r").over(own))
        mean, sd = F.col("_m"), F.col("_s")
    else:
        raise ValueError(f"scope must be pooled or scheme, got {scope!r}")
    r = F.col("r")
    return rows.where(_is_extreme(mean, sd, threshold_std)).select(
        KEY,
        "scheme_name",
        "date",
        half_up("nav", 4).alias("nav"),
        half_up(r * 100, 2).alias("daily_return"),
        half_up(F.try_divide(F.abs(r - mean), sd), 2).alias("std_deviations"),
        F.when(r > 0, F.lit("extreme_positive")).otherwise(F.lit("extreme_negative")).alias("anomaly_type"),
    )


def nav_jumps(
    nav: DataFrame,
    threshold: float = JUMP_THRESHOLD,
    error_threshold: float = DATA_ERROR_THRESHOLD,
    min_data_points: int = MIN_DATA_POINTS,
    rows: DataFrame | None = None,
) -> DataFrame:
    """OP46: moves |Δnav / previous nav| > ``threshold``; flagged as a possible error above ``error_threshold``."""
    moves = _with_moves(_rows(nav, min_data_points, rows))
    change, pct = F.col("_change"), F.col("_change_pct")
    return moves.where(_is_jump(threshold)).select(
        KEY,
        "scheme_name",
        "date",
        half_up(F.col("nav") - change, 4).alias("nav_before"),
        half_up("nav", 4).alias("nav_after"),
        half_up(change, 4).alias("nav_change"),
        half_up(pct * 100, 2).alias("nav_change_percent"),
        (F.abs(pct) > error_threshold).alias("possible_data_error"),
    )


def _with_runs(rows: DataFrame) -> DataFrame:
    """Adds ``_run``: rows since the last one whose NAV wasn't that of the row before; by windows, so there is no group for each run."""
    same = F.coalesce(F.col("nav") == F.lag("nav").over(_series()), F.lit(False))
    numbered = rows.withColumn("_same", same).withColumn("_pos", F.row_number().over(_series()))
    running = _series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.max(F.when(~F.col("_same"), F.col("_pos"))).over(running)
    return numbered.withColumn("_run", (F.col("_pos") - start).cast("bigint"))


def _runs(rows: DataFrame) -> DataFrame:
    """Per scheme: longest run of NAV equal to the previous analysed NAV."""
    return _with_runs(rows).groupBy(KEY).agg(
        F.max("_run").alias("max_consecutive_unchanged"),
        F.min_by("scheme_name", "date").alias("scheme_name"),
    )


def stale_nav(
    nav: DataFrame, min_run: int = STALE_MIN_RUN, min_data_points: int = MIN_DATA_POINTS, rows: DataFrame | None = None
) -> DataFrame:
    """OP47: schemes whose NAV stayed unchanged for at least ``min_run`` consecutive days."""
    return stale_columns(_runs(_rows(nav, min_data_points, rows)), min_run)


def stale_columns(runs: DataFrame, min_run: int) -> DataFrame:
    """The columns of OP47 from a scheme's longest run."""
    return runs.where(F.col("max_consecutive_unchanged") >= min_run).select(
        KEY,
        "scheme_name",
        F.lit("stale_nav").alias("pattern_type"),
        "max_consecutive_unchanged",
        F.format_string("NAV unchanged for %d consecutive days", "max_consecutive_unchanged").alias("description"),
    )


def invalid_nav_rows(nav: DataFrame, min_data_points: int = MIN_DATA_POINTS, rows: DataFrame | None = None) -> DataFrame:
    """OP48: analysed rows with nav ≤ 0 or nav > 10000."""
    return _rows(nav, min_data_points, rows).where(_is_invalid()).select(
        KEY,
        "scheme_name",
        "date",
        "nav",
        F.lit("invalid_nav_value").alias("issue_type"),
        F.concat(F.lit("NAV value "), F.col("nav").cast("string"), F.lit(" is outside reasonable range")).alias(
            "description"
        ),
    )


def anomaly_summary(
    nav: DataFrame,
    threshold_std: float = DEFAULT_STD_THRESHOLD,
    jump_threshold: float = JUMP_THRESHOLD,
    min_run: int = STALE_MIN_RUN,
    min_data_points: int = MIN_DATA_POINTS,
    rows: DataFrame | None = None,
) -> DataFrame:
    """OP49: counts of OP45-OP48 (stale counts schemes), rate % (3 dp) and health score (1 dp).

    One pass: per-row flags → per scheme → one row, all on the scheme_code
    partitioning; no group is smaller than a scheme.
    """
    rows = _rows(nav, min_data_points, rows)
    mean, sd = _pooled(rows)
    per_scheme = _with_runs(_with_moves(rows)).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(_is_extreme(mean, sd, threshold_std)).alias("_ext"),
        F.count_if(F.coalesce(_is_jump(jump_threshold), F.lit(False))).alias("_jump"),
        F.count_if(_is_invalid()).alias("_bad"),
        F.max("_run").alias("_run"),
        F.min("date").alias("_start"),
        F.max("date").alias("_end"),
    )
    s = per_scheme.agg(
        F.sum("_rows").alias("total_data_points_analyzed"),
        F.count(F.lit(1)).alias("unique_schemes_analyzed"),
        F.min("_start").alias("start"),
        F.max("_end").alias("end"),
        F.sum("_ext").alias("extreme_returns"),
        F.sum("_jump").alias("nav_jumps"),
        F.count_if(F.col("_run") >= min_run).alias("suspicious_patterns"),
        F.sum("_bad").alias("data_quality_issues"),
    ).where(F.col("total_data_points_analyzed") > 0)
    return summary_columns(s)


def summary_columns(s: DataFrame) -> DataFrame:
    """The columns of OP49 from its counts."""
    total = F.col("extreme_returns") + F.col("nav_jumps") + F.col("suspicious_patterns") + F.col("data_quality_issues")
    rate = F.try_divide(total, F.col("total_data_points_analyzed")) * 100
    return s.select(
        F.col("total_data_points_analyzed").cast("bigint").alias("total_data_points_analyzed"),
        "unique_schemes_analyzed",
        "start",
        "end",
        F.col("extreme_returns").cast("bigint").alias("extreme_returns"),
        F.col("nav_jumps").cast("bigint").alias("nav_jumps"),
        "suspicious_patterns",
        F.col("data_quality_issues").cast("bigint").alias("data_quality_issues"),
        total.cast("bigint").alias("total_anomalies"),
        half_up(rate, 3).alias("anomaly_rate"),
        F.greatest(F.lit(0.0), half_up(100 - rate, 1)).alias("data_health_score"),
    )
