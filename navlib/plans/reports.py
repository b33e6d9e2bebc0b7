"""Whole reports: every block of one analysis from one shared, checkpointed base.

Each function corresponds to one report of the reference (performance,
comparison, top performers, volatility, anomalies, correlation, quality,
duplicates) and returns a dict of DataFrames, one per block.  The expensive
base (daily returns over all schemes, the analysed rows, the selected
schemes' returns) is computed once and checkpointed to the cluster's
checkpoint folder, so the blocks read it instead of re-shuffling the NAV
table, and a lost executor does not force the base to be recomputed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navlib.functions.stats import half_up
from navlib.operators import anomaly as A
from navlib.operators import correlation as C
from navlib.operators import quality as Q
from navlib.operators import returns as P
from navlib.operators import risk as V
from navlib.session import checkpointed


def performance_report(nav: DataFrame, periods: Sequence[int] = P.DEFAULT_PERIODS) -> dict[str, DataFrame]:
    """Per scheme and period: header, period returns and return statistics (OP29-OP32)."""
    return {"scheme_performance": P.scheme_performance(nav, periods)}


def comparison_report(nav: DataFrame, codes: Sequence[str] | None = None, period: int = 365) -> dict[str, DataFrame]:
    """OP33-OP35 from one comparison frame (checkpointed once)."""
    compared = checkpointed(P.compare_schemes(nav, codes, period))
    return {
        "schemes": compared,
        "comparative_metrics": P.compare_statistics(compared),
        "summary": P.compare_summary(compared),
    }


def top_performers_report(
    nav: DataFrame,
    master: DataFrame | None = None,
    category: str | None = None,
    period: int = 365,
    limit: int = 10,
    sort_by: str = "return",
) -> dict[str, DataFrame]:
    """OP36 + OP37 over the same per-scheme figures (computed once)."""
    perf = checkpointed(P.period_performance(P._candidates(nav, master, category), period))
    order = P._order(sort_by)
    top = perf.select(*P._TOP_COLUMNS).orderBy(*order).limit(limit)
    return {
        "top_performers": top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")),
        "summary_statistics": P.top_performer_statistics(perf),
    }


def volatility_report(nav: DataFrame, window: int = V.DEFAULT_WINDOW) -> dict[str, DataFrame]:
    """OP38-OP44 from one checkpointed frame of analysed returns."""
    rets = checkpointed(V.analysed_returns(nav))
    return {
        "basic_volatility": V.basic_volatility(nav, rets),
        "rolling_volatility": V.rolling_volatility(nav, window, rets),
        "downside_risk": V.downside_risk(nav, rets),
        "upside_potential": V.upside_potential(nav, rets),
        "risk_statistics": V.risk_statistics(nav, rets),
        "value_at_risk": V.value_at_risk(nav, rets),
        "volatility_assessment": V.volatility_regime(nav, rets),
    }


def anomaly_report(
    nav: DataFrame,
    threshold_std: float = A.DEFAULT_STD_THRESHOLD,
    min_data_points: int = A.MIN_DATA_POINTS,
) -> dict[str, DataFrame]:
    """OP45-OP49 from one checkpointed frame of analysed rows."""
    rows = checkpointed(A.analysed_rows(nav, min_data_points))
    return {
        "extreme_returns": A.extreme_returns(nav, threshold_std, rows=rows),
        "nav_jumps": A.nav_jumps(nav, rows=rows),
        "suspicious_patterns": A.stale_nav(nav, rows=rows),
        "data_quality_issues": A.invalid_nav_rows(nav, rows=rows),
        "summary_statistics": A.anomaly_summary(nav, threshold_std, rows=rows),
    }


def correlation_report(
    nav: DataFrame,
    codes: Sequence[str] | str | None = None,
    since: str | dt.date | None = None,
    min_overlap: int = C.DEFAULT_MIN_OVERLAP,
    top_k: int | None = None,
) -> dict[str, DataFrame]:
    """OP51-OP56 from one selection of schemes and one returns matrix."""
    inp = C._prepare(nav, codes, since, min_overlap, top_k)
    rho = checkpointed(C._pearson(inp))
    pairs = C._pairs_from(rho, inp, C.HIGH_CORRELATION, C.LOW_CORRELATION)
    stats = C._statistics_from(rho)
    n_high = pairs.where(F.col("kind") == "high").select(F.count(F.lit(1))).scalar()
    return {
        "data_availability": inp.availability,
        "returns_matrix": inp.matrix.select("date", C.KEY, "r"),
        "correlation_matrix": rho.select("scheme1", "scheme2", half_up("rho", 4).alias("correlation"), "overlap_days"),
        "notable_pairs": pairs.select(
            "scheme1", "scheme1_name", "scheme2", "scheme2_name", half_up("rho", 4).alias("correlation"), "kind"
        ),
        "correlation_statistics": C._statistics_columns(stats),
        "investment_insights": C._insights(stats, n_high, inp.n_valid),
    }


def quality_report(nav: DataFrame) -> dict[str, DataFrame]:
    """OP19-OP24."""
    return {
        "null_checks": Q.dq_null_checks(nav),
        "invalid_nav_values": Q.dq_invalid_nav(nav),
        "duplicate_records": Q.dq_duplicates(nav),
        "date_consistency": Q.dq_date_consistency(nav),
        "scheme_code_validation": Q.dq_code_format(nav),
        "overall_quality": Q.dq_overall(nav),
    }


def duplicate_report(master: DataFrame) -> dict[str, DataFrame]:
    """OP25-OP28."""
    return {
        "duplicate_codes": Q.duplicate_codes(master),
        "similar_names": Q.similar_names(master),
        "duplicate_names": Q.duplicate_names(master),
        "summary": Q.duplicate_summary(master),
    }
