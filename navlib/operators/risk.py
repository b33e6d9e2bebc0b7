"""Volatility and risk (OP38-OP44), for every scheme at once.

A scheme is analysed when it has at least 30 NAV rows and 20 daily returns.
Returns rows without a return (each scheme's first row) or without a name
are dropped before the statistics, as the report defines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.functions.stats import (
    ANNUAL_SQRT,
    TRADING_DAYS_MONTH,
    TRADING_DAYS_WEEK,
    bias_corrected_kurtosis,
    bias_corrected_skewness,
    half_up,
    sqrt_days,
)
from navlib.operators.returns import daily_returns

KEY = "scheme_code"

# Eligibility and classification thresholds of the volatility report.
MIN_NAV_ROWS = 30
MIN_RETURNS = 20
DEFAULT_WINDOW = 252
REGIMES = [(0.10, "Low Volatility"), (0.20, "Moderate Volatility"), (0.35, "High Volatility")]
REGIME_TOP = "Very High Volatility"
RISK_LEVELS = [(0.15, "Low"), (0.25, "Medium")]
RISK_TOP = "High"


def _whole(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def analysed_returns(nav: DataFrame, min_rows: int = MIN_NAV_ROWS, min_returns: int = MIN_RETURNS) -> DataFrame:
    """Return rows of the schemes eligible for the volatility report."""
    series = Window.partitionBy(KEY).orderBy("date")
    ret = daily_returns(nav).withColumn("_rows", F.count(F.lit(1)).over(_whole(series)))
    kept = ret.where(F.col("r").isNotNull() & F.col("scheme_name").isNotNull() & (F.col("_rows") >= min_rows))
    return kept.withColumn("_nr", F.count(F.lit(1)).over(_whole(series))).where(F.col("_nr") >= min_returns).drop(
        "_rows", "_nr"
    )


def _analysed(nav: DataFrame, analysed: DataFrame | None) -> DataFrame:
    """``analysed`` (rows of ``analysed_returns``, e.g. checkpointed by a report) or computed from ``nav``."""
    return analysed if analysed is not None else analysed_returns(nav)


def basic_volatility(nav: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """OP38: sample sd of daily returns scaled to week, month and year, with the window analysed."""
    return basic_columns(
        _analysed(nav, analysed)
        .groupBy(KEY)
        .agg(
            F.min_by("scheme_name", "date").alias("scheme_name"),
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
            F.count(F.lit(1)).alias("total_days"),
            F.stddev_samp("r").alias("_sd"),
        )
    )


def basic_columns(per: DataFrame) -> DataFrame:
    """The columns of OP38 from a scheme's figures."""
    sd = F.col("_sd")
    return per.select(
        KEY,
        "scheme_name",
        "start_date",
        "end_date",
        "total_days",
        half_up(sd, 6).alias("daily_volatility"),
        half_up(sd * F.lit(sqrt_days(TRADING_DAYS_WEEK)), 6).alias("weekly_volatility"),
        half_up(sd * F.lit(sqrt_days(TRADING_DAYS_MONTH)), 5).alias("monthly_volatility"),
        half_up(sd * F.lit(ANNUAL_SQRT), 4).alias("annualized_volatility"),
    )


def rolling_volatility(nav: DataFrame, window: int = DEFAULT_WINDOW, analysed: DataFrame | None = None) -> DataFrame:
    """OP39: annualised sd over each full window of ``window`` returns, summarised per scheme.

    Linear in the rows, whatever the window: a scheme's rows are cut into
    blocks of ``window``, and a frame is the end of one block and the start of
    the next.  Count, mean and squared deviations of all starts and all ends
    are running aggregates, and merging two of them gives the frame's.
    Nothing is subtracted, so one wild NAV (1e-6, 1e8) spoils its own frames only.
    Only schemes with at least ``window`` returns are reported.
    """
    if window < 2:
        raise ValueError("window must be at least 2")
    series = Window.partitionBy(KEY).orderBy("date")
    running = (Window.unboundedPreceding, Window.currentRow)
    block = Window.partitionBy(KEY, "_block")
    head, tail = block.orderBy("date").rowsBetween(*running), block.orderBy(F.col("date").desc()).rowsBetween(*running)
    x = _analysed(nav, analysed).select(KEY, "date", "r").withColumn("_k", F.row_number().over(series))
    x = x.withColumn("_block", F.floor((F.col("_k") - 1) / window))
    x = x.withColumn("_tail", F.struct(F.avg("r").over(tail).alias("mean"), F.var_pop("r").over(tail).alias("var")))
    x = x.withColumn("_head", F.struct(F.avg("r").over(head).alias("mean"), F.var_pop("r").over(head).alias("var")))
    x = x.withColumn("_tail", F.lag("_tail", window - 1).over(series))
    n1 = F.col("_k") - F.col("_block") * window  # rows of the frame in this block, n2 in the one before
    n2 = window - n1
    apart = F.col("_tail.mean") - F.col("_head.mean")
    merged = F.col("_head.var") * n1 + F.col("_tail.var") * n2 + apart * apart * n1 * n2 / window
    squares = F.when(n2 == 0, F.col("_head.var") * n1).otherwise(merged)
    rolling = F.when(F.col("_k") >= window, F.sqrt(squares / (window - 1)) * F.lit(ANNUAL_SQRT))
    v = F.col("_vol")
    return (
        x.withColumn("_vol", rolling)
        .where(v.isNotNull())
        .groupBy(KEY)
        .agg(
            F.max_by(v, "date").alias("_cur"),
            F.avg(v).alias("_avg"),
            F.min(v).alias("_min"),
            F.max(v).alias("_max"),
            F.stddev_samp(v).alias("_sd"),
        )
        .select(
            KEY,
            half_up("_cur", 4).alias("current_rolling_vol"),
            half_up("_avg", 4).alias("average_rolling_vol"),
            half_up("_min", 4).alias("min_rolling_vol"),
            half_up("_max", 4).alias("max_rolling_vol"),
            half_up("_sd", 4).alias("volatility_of_volatility"),
        )
    )


def _side_risk(nav: DataFrame, analysed: DataFrame | None, picked: Column, extreme: Column) -> DataFrame:
    side = F.col("_side")
    return (
        _analysed(nav, analysed)
        .withColumn("_side", F.when(picked, F.col("r")))
        .groupBy(KEY)
        .agg(
            F.count("_side").alias("_m"),
            F.count(F.lit(1)).alias("_n"),
            F.stddev_samp(side).alias("_sd"),
            F.avg(side).alias("_mean"),
            extreme.alias("_ext"),
        )
    )


def _side_columns(per: DataFrame, prefix: str, extreme_name: str, day_name: str) -> DataFrame:
    return per.where(F.col("_m") > 0).select(
        KEY,
        half_up(F.col("_sd") * F.lit(ANNUAL_SQRT), 4).alias(f"{prefix}_volatility"),
        half_up(F.try_divide(F.col("_m"), F.col("_n")), 3).alias(f"{prefix}_frequency"),
        half_up(F.col("_mean") * 100, 2).alias(day_name),
        half_up(F.col("_ext") * 100, 2).alias(extreme_name),
    )


def downside_columns(per: DataFrame) -> DataFrame:
    """The columns of OP40 from a scheme's figures."""
    return _side_columns(per, "downside", "worst_single_day", "average_down_day")


def upside_columns(per: DataFrame) -> DataFrame:
    """The columns of OP41 from a scheme's figures."""
    return _side_columns(per, "upside", "best_single_day", "average_up_day")


def downside_risk(nav: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """OP40: over negative returns: annualised sd, frequency, mean % and worst day %."""
    return downside_columns(_side_risk(nav, analysed, F.col("r") < 0, F.min("_side")))


def upside_potential(nav: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """OP41: over positive returns: annualised sd, frequency, mean % and best day %."""
    return upside_columns(_side_risk(nav, analysed, F.col("r") > 0, F.max("_side")))


def risk_statistics(nav: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """OP42: mean % (3 dp), sample skewness and excess kurtosis (3 dp), mean/sd, sd/|mean|.

    mean/sd is 0 when sd is 0; sd/|mean| is +inf when the mean is 0.
    """
    return statistics_columns(
        _analysed(nav, analysed)
        .groupBy(KEY)
        .agg(
            F.avg("r").alias("_mean"),
            F.stddev_samp("r").alias("_sd"),
            bias_corrected_skewness("r").alias("_skew"),
            bias_corrected_kurtosis("r").alias("_kurt"),
        )
    )


def statistics_columns(per: DataFrame) -> DataFrame:
    """The columns of OP42 from a scheme's figures."""
    mean, sd = F.col("_mean"), F.col("_sd")
    return per.select(
        KEY,
        half_up(mean * 100, 3).alias("mean_daily_return"),
        half_up("_skew", 3).alias("return_skewness"),
        half_up("_kurt", 3).alias("return_kurtosis"),
        F.when(sd > 0, half_up(F.try_divide(mean, sd), 3)).otherwise(F.lit(0.0)).alias("sharpe_ratio_approx"),
        F.when(mean != 0, half_up(F.try_divide(sd, F.abs(mean)), 2)).otherwise(F.lit(float("inf"))).alias(
            "coefficient_of_variation"
        ),
    )


def value_at_risk(nav: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """OP43: 5 % and 1 % quantiles (linear interpolation), mean of returns ≤ the 5 % quantile, worst day.

    The 5 % quantile is a window aggregate over the scheme, so the expected
    shortfall needs no second shuffle or join.
    """
    series = Window.partitionBy(KEY).orderBy("date")
    x = _analysed(nav, analysed).withColumn("_q05", F.percentile("r", 0.05).over(_whole(series)))
    return (
        x.groupBy(KEY)
        .agg(
            F.first("_q05").alias("_q05"),
            F.percentile("r", 0.01).alias("_q01"),
            F.avg(F.when(F.col("r") <= F.col("_q05"), F.col("r"))).alias("_es"),
            F.min("r").alias("_min"),
        )
        .select(
            KEY,
            half_up(F.col("_q05") * 100, 2).alias("var_95_percent"),
            half_up(F.col("_q01") * 100, 2).alias("var_99_percent"),
            half_up(F.col("_es") * 100, 2).alias("expected_shortfall_95"),
            half_up(F.col("_min") * 100, 2).alias("max_drawdown_single_day"),
        )
    )


def _ladder(value: Column, steps: list[tuple[float, str]], top: str) -> Column:
    expr = None
    for bound, label in steps:
        expr = F.when(value < bound, F.lit(label)) if expr is None else expr.when(value < bound, F.lit(label))
    return expr.otherwise(F.lit(top))


def volatility_regime(nav: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """OP44: regime and risk level from the annualised volatility, with a sentence."""
    return regime_columns(_analysed(nav, analysed).groupBy(KEY).agg((F.stddev_samp("r") * F.lit(ANNUAL_SQRT)).alias("_vol")))


def regime_columns(per: DataFrame) -> DataFrame:
    """The columns of OP44 from a scheme's annualised volatility."""
    vol, regime = F.col("_vol"), F.col("regime")
    per = per.select(KEY, "_vol", _ladder(vol, REGIMES, REGIME_TOP).alias("regime"))
    pct_text = half_up(vol * 100, 1).cast("string")
    return per.select(
        KEY,
        regime,
        _ladder(vol, RISK_LEVELS, RISK_TOP).alias("risk_level"),
        F.concat(
            F.lit("This scheme has "),
            F.lower(regime),
            F.lit(" with annualized volatility of "),
            pct_text,
            F.lit("%"),
        ).alias("interpretation"),
    )
