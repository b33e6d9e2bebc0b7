"""Returns and performance (OP29-OP37).

All schemes are analysed in one job.  The plan is Scan → Exchange
hash(scheme_code) → Sort → Window (lag, row_number, count) → HashAggregate on
the same key, so a report costs one shuffle of the NAV rows.  A scheme has
at most one row per date after ``daily_returns`` removes duplicate keys, so
every per-scheme window and aggregate is bounded by the calendar, not by the
table size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navlib.functions.ranking import global_ranks
from navlib.functions.selection import value_at
from navlib.operators.master import category_filter, scheme_master
from navlib.session import checkpointed
from navlib.functions.stats import ANNUAL_SQRT, CALENDAR_DAYS_YEAR, growth_percent, half_up

KEY = "scheme_code"
DEFAULT_PERIODS = (30, 90, 180, 365)
SORT_KEYS = ("return", "volatility", "risk_adjusted")


def _series() -> Window:
    return Window.partitionBy(KEY).orderBy("date")


def current_rows(nav: DataFrame) -> DataFrame:
    """(scheme_code, scheme_name, date, nav): one row per key, without null codes, dates or NAVs.

    Of rows that share (scheme_code, date) the newest load wins where the
    frame has load_id / loaded_at (tables written by ``ingest_nav`` keep older
    versions), then the largest NAV and name.  The aggregate combines before
    it shuffles, so a scheme repeated in a third of the rows sends one row per
    date and task.
    """
    rows = nav.where(F.col(KEY).isNotNull() & F.col("date").isNotNull() & F.col("nav").isNotNull())
    loads = [c for c in ("load_id", "loaded_at") if c in nav.columns]
    newest = F.max(F.struct(*loads, "nav", "scheme_name"))
    return rows.groupBy(KEY, "date").agg(newest.alias("_v")).select(KEY, "_v.scheme_name", "date", "_v.nav")


def daily_returns(nav: DataFrame) -> DataFrame:
    """OP29: r = nav / previous nav - 1 per scheme in date order, over ``current_rows``.

    The first row of a scheme has r = NULL, as does a row after a zero NAV.
    """
    return current_rows(nav).withColumn("r", F.try_divide(F.col("nav"), F.lag("nav").over(_series())) - 1)


def _with_positions(returns: DataFrame) -> DataFrame:
    whole = _series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return returns.withColumn("_pos", F.row_number().over(_series())).withColumn(
        "_n", F.count(F.lit(1)).over(whole)
    )


def _start_of(period: int) -> Column:
    # p rows before the last one, or the first row when the series is not longer than p
    hit = F.col("_pos") == F.greatest(F.col("_n") - F.lit(period), F.lit(1))
    return F.max(F.when(hit, F.struct(F.col("date").alias("d"), F.col("nav").alias("v"))))


def _rollup(nav: DataFrame, periods: Sequence[int]) -> DataFrame:
    """One row per scheme with everything the performance reports need (unrounded)."""
    pos = _with_positions(daily_returns(nav))
    return pos.groupBy(KEY).agg(
        F.min_by("scheme_name", "date").alias("scheme_name"),
        F.max_by("nav", "date").alias("_cur_nav"),
        F.max("date").alias("current_date"),
        F.count(F.lit(1)).alias("data_points"),
        F.count("r").alias("_nr"),
        F.stddev_samp("r").alias("_sd"),
        F.max("r").alias("_rmax"),
        F.min("r").alias("_rmin"),
        F.count_if(F.col("r") > 0).alias("positive_days"),
        F.count_if(F.col("r") < 0).alias("negative_days"),
        *[_start_of(p).alias(f"_start{p}") for p in periods],
    )


def _period_columns(period: Column) -> list[Column]:
    cur = F.col("_cur_nav")
    start = F.col("_s.v")
    days = F.when(F.col("data_points") <= period, F.col("data_points") - 1).otherwise(period)
    ratio = F.try_divide(cur, start)
    growth = F.pow(ratio, F.try_divide(F.lit(CALENDAR_DAYS_YEAR), days))
    annualized = F.when(
        (days > 0) & (ratio >= 0) & ~F.isnan(growth) & (F.abs(growth) != F.lit(float("inf"))),
        growth_percent((growth - 1) * 100),
    )
    return [
        half_up(cur - start, 4).alias("absolute_return"),
        half_up(F.try_divide(cur - start, start) * 100, 2).alias("percentage_return"),
        annualized.alias("annualized_return"),
        F.col("_s.d").alias("start_date"),
        half_up(start, 4).alias("start_nav"),
        days.cast("bigint").alias("days_actual"),
    ]


def _explode_periods(rollup: DataFrame, periods: Sequence[int]) -> DataFrame:
    items = F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"_start{p}").alias("s")) for p in periods])
    return rollup.withColumn("_p", F.explode(items)).withColumn("period", F.col("_p.period")).withColumn("_s", F.col("_p.s"))


def _stat_columns() -> list[Column]:
    sd = F.col("_sd")
    return [
        half_up(sd, 6).alias("daily_volatility"),
        half_up(sd * F.lit(ANNUAL_SQRT), 4).alias("annualized_volatility"),
        half_up(F.col("_rmax") * 100, 2).alias("max_daily_gain"),
        half_up(F.col("_rmin") * 100, 2).alias("max_daily_loss"),
        F.col("positive_days"),
        F.col("negative_days"),
        half_up(F.try_divide(F.col("positive_days"), F.col("_nr")) * 100, 1).alias("win_rate"),
    ]


def _check_periods(periods: Sequence[int]) -> list[int]:
    out = [int(p) for p in periods]
    if not out or any(p < 1 for p in out):
        raise ValueError("periods must be positive row counts")
    return list(dict.fromkeys(out))


def period_returns(nav: DataFrame, periods: Sequence[int] = DEFAULT_PERIODS) -> DataFrame:
    """OP30: return over the last p observations (rows, not calendar days) per scheme and period."""
    periods = _check_periods(periods)
    rows = _explode_periods(_rollup(nav, periods), periods)
    return rows.select(KEY, F.col("period").cast("int").alias("period"), *_period_columns(F.col("period")))


def return_stats(returns: DataFrame) -> DataFrame:
    """OP31: daily-return statistics per scheme (schemes with at least one return)."""
    per = (
        returns.where(F.col("r").isNotNull())
        .groupBy(KEY)
        .agg(
            F.count("r").alias("_nr"),
            F.stddev_samp("r").alias("_sd"),
            F.max("r").alias("_rmax"),
            F.min("r").alias("_rmin"),
            F.count_if(F.col("r") > 0).alias("positive_days"),
            F.count_if(F.col("r") < 0).alias("negative_days"),
        )
    )
    return per.select(KEY, *_stat_columns())


def scheme_performance(nav: DataFrame, periods: Sequence[int] = DEFAULT_PERIODS) -> DataFrame:
    """OP32: header + period returns + return statistics, one row per (scheme, period).

    Schemes need at least two NAV rows.  The name is the one on the
    scheme's earliest row.
    """
    periods = _check_periods(periods)
    rows = _explode_periods(_rollup(nav, periods).where(F.col("data_points") >= 2), periods)
    return rows.select(
        KEY,
        "scheme_name",
        half_up("_cur_nav", 4).alias("current_nav"),
        "current_date",
        "data_points",
        F.col("period").cast("int").alias("period"),
        *_period_columns(F.col("period")),
        *_stat_columns(),
    )


def period_performance(nav: DataFrame, period: int = 365, min_rows: int = 2) -> DataFrame:
    """Per-scheme figures used by comparisons and rankings for one period.

    risk_adjusted_return = rounded % return / rounded volatility (2 dp),
    0 when the volatility is not positive or undefined.
    """
    period = _check_periods([period])[0]
    rows = _explode_periods(_rollup(nav, [period]).where(F.col("data_points") >= min_rows), [period])
    perf = rows.select(
        KEY,
        "scheme_name",
        half_up("_cur_nav", 4).alias("current_nav"),
        "data_points",
        *_period_columns(F.col("period")),
        *_stat_columns(),
    )
    return perf.withColumnRenamed("annualized_volatility", "volatility").withColumn(
        "risk_adjusted_return",
        F.when(F.col("volatility") > 0, half_up(F.try_divide(F.col("percentage_return"), F.col("volatility")), 2)).otherwise(F.lit(0.0)),
    )


def _order(sort_by: str) -> list[Column]:
    if sort_by == "return":
        first = F.col("percentage_return").desc_nulls_last()
    elif sort_by == "volatility":
        first = F.col("volatility").asc_nulls_last()
    elif sort_by == "risk_adjusted":
        first = F.col("risk_adjusted_return").desc_nulls_last()
    else:
        raise ValueError(f"sort_by must be one of {SORT_KEYS}, got {sort_by!r}")
    return [first, F.col(KEY).asc()]


# Column names of the reports.
_COMPARE_COLUMNS = [
    KEY,
    "scheme_name",
    "current_nav",
    "absolute_return",
    "percentage_return",
    "annualized_return",
    "volatility",
    "win_rate",
    "data_points",
    "risk_adjusted_return",
]


def compare_schemes(nav: DataFrame, codes: Sequence[str] | None = None, period: int = 365) -> DataFrame:
    """OP33: side-by-side performance with return, risk and risk-adjusted ranks.

    ``codes`` is the list to compare (at least two); None compares every
    scheme in ``nav``.  Requested codes without two NAV rows get status
    ``failed``.  Ranks are given when at least two schemes are valid; ties
    break on scheme_code.
    """
    spark = nav.sparkSession
    if codes is not None:
        codes = list(dict.fromkeys(str(c) for c in codes))
        if len(codes) < 2:
            raise ValueError("need at least 2 schemes to compare")
        requested = spark.createDataFrame([(c,) for c in codes], f"{KEY} string")
        nav = nav.join(requested, KEY, "left_semi")
    else:
        requested = None
    # one scan: schemes with a single row are kept here and become "failed" below
    every = checkpointed(period_performance(nav, period, min_rows=1).select(*_COMPARE_COLUMNS))
    if requested is None:
        requested = every.select(KEY)
    perf = every.where(F.col("data_points") >= 2)
    # the three rankings share one distributed sort (ties break on scheme_code)
    ranks = global_ranks(
        perf,
        KEY,
        {
            "return_rank": ("percentage_return", True),
            "risk_rank": ("volatility", False),
            "risk_adjusted_rank": ("risk_adjusted_return", True),
        },
    )
    ranked = perf.join(ranks, KEY)
    valid = perf.select(F.count(F.lit(1))).scalar()
    rank_cols = [F.when(valid >= 2, F.col(c)).alias(c) for c in ("return_rank", "risk_rank", "risk_adjusted_rank")]
    return (
        requested.join(ranked, KEY, "left")
        .select(
            *_COMPARE_COLUMNS,
            *rank_cols,
            F.when(F.col("data_points").isNotNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        )
    )


def compare_statistics(compared: DataFrame) -> DataFrame:
    """OP34: spread of return and volatility over the valid compared schemes (needs ≥ 2)."""
    ok = compared.where(F.col("status") == "ok")
    ret, vol = F.col("percentage_return"), F.col("volatility")
    return (
        ok.agg(
            F.count(F.lit(1)).alias("_n"),
            F.max(ret).alias("highest_return"),
            F.min(ret).alias("lowest_return"),
            half_up(F.avg(ret), 2).alias("average_return"),
            half_up(F.max(ret) - F.min(ret), 2).alias("return_spread"),
            F.max(vol).alias("highest_volatility"),
            F.min(vol).alias("lowest_volatility"),
            half_up(F.avg(vol), 4).alias("average_volatility"),
        )
        .where(F.col("_n") >= 2)
        .drop("_n")
    )


def compare_summary(compared: DataFrame) -> DataFrame:
    """OP35: best / worst performer, least / most risky, best risk-adjusted (codes)."""
    ranked = compared.where(F.col("return_rank").isNotNull())
    code = F.col(KEY)
    return (
        ranked.agg(
            F.count(F.lit(1)).alias("_n"),
            F.min_by(code, "return_rank").alias("best_performer"),
            F.max_by(code, "return_rank").alias("worst_performer"),
            F.min_by(code, "risk_rank").alias("least_risky"),
            F.max_by(code, "risk_rank").alias("most_risky"),
            F.min_by(code, "risk_adjusted_rank").alias("best_risk_adjusted"),
        )
        .where(F.col("_n") >= 2)
        .drop("_n")
    )


_TOP_COLUMNS = [
    KEY,
    "scheme_name",
    "current_nav",
    "percentage_return",
    "annualized_return",
    "volatility",
    "risk_adjusted_return",
    "win_rate",
    "max_daily_gain",
    "data_points",
]


def _candidates(nav: DataFrame, master: DataFrame | None, category: str | None) -> DataFrame:
    if not category:
        return nav
    source = master if master is not None else scheme_master(nav)
    codes = source.where(category_filter(category)).select(KEY)
    return nav.join(codes, KEY, "left_semi")


def top_performers(
    nav: DataFrame,
    master: DataFrame | None = None,
    category: str | None = None,
    period: int = 365,
    limit: int = 10,
    sort_by: str = "return",
) -> DataFrame:
    """OP36: the ``limit`` best schemes by return, volatility or risk-adjusted return.

    Every scheme (optionally those whose name matches ``category`` in the
    master) is analysed; the top-k is a TakeOrderedAndProject, and the rank
    window runs over those k rows only.
    """
    order = _order(sort_by)
    if limit < 1:
        raise ValueError("limit must be positive")
    perf = period_performance(_candidates(nav, master, category), period).select(*_TOP_COLUMNS)
    top = perf.orderBy(*order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_performer_statistics(perf: DataFrame) -> DataFrame:
    """OP37: summary over all analysed schemes (``period_performance`` rows).

    median_return is the upper median, element n div 2 of the sorted
    returns, found by counting in narrowing bins (``functions.selection``).
    """
    ret, vol = F.col("percentage_return"), F.col("volatility")
    # one row per scheme, read three times below: computed once
    perf = checkpointed(perf.select(KEY, "percentage_return", "volatility"))
    median = F.lit(value_at(perf, "percentage_return", lambda n: n // 2 + 1)).cast("double")
    positive_vol = F.when(vol > 0, vol)
    return perf.agg(
        F.count(F.lit(1)).alias("total_schemes_analyzed"),
        half_up(F.avg(ret), 2).alias("average_return"),
        F.max(ret).alias("top_return"),
        F.min(ret).alias("bottom_return"),
        half_up(F.avg(positive_vol), 4).alias("average_volatility"),
        F.min(positive_vol).alias("lowest_volatility"),
        F.max(positive_vol).alias("highest_volatility"),
    ).select(
        "total_schemes_analyzed",
        "average_return",
        half_up(median, 2).alias("median_return"),
        "top_return",
        "bottom_return",
        "average_volatility",
        "lowest_volatility",
        "highest_volatility",
    )
