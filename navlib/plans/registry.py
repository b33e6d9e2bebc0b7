"""The registered query set: one Spark query and one DuckDB oracle per operator.

Every query reads the driver's tables through the fixture views of
``navlib.sources.fixtures`` (whole tables, no sampling).  The oracle is the
same computation written as plain SQL over the same views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import navlib as nl
from navlib.operators import monthly
from navlib.operators.master import with_partition_columns
from navlib.sources import fixtures as fx
from navlib.sources.store import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (fixed values).
ON_DATE = "1998-06-15"
RANGE_START, RANGE_END = "1998-01-01", "1998-03-31"
CORRECTED_BEFORE = "1998-02-15"
LAST_QUARTER = "1998-10-01"
SINCE = "1998-01-01"
KEYWORD = "promo"
HOUSE_KEYWORD = "brand#1"
AS_OF = "2001-11-05"
PERIODS = (30, 90, 180, 365)
PERIOD = 365
TOP_LIMIT = 10
ROLLING_WINDOW = 252
MIN_OVERLAP = 100
TOP_K = 10


def _stored_nav(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "nav_data")
    nl.write_table(with_partition_columns(fx.nav_s(spark, sf_dir)), path, ["year", "month"], "overwrite")
    return path


def _write_table(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(_stored_nav(spark, d))


def _read_table(spark: SparkSession, d: str) -> DataFrame:
    return nl.read_table(spark, _stored_nav(spark, d))


def _ingest(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "nav_data")
    batch = nl.parse_nav_text(fx.feed_lines(spark, d))
    nl.ingest_nav(batch, path, load_id=1)
    nl.ingest_nav(batch, path, load_id=2)  # same feed again: adds nothing
    return nl.read_table(spark, path).drop("loaded_at")


def _compact(spark: SparkSession, d: str) -> DataFrame:
    src = _stored_nav(spark, d)
    return nl.compact_table(spark, src, scratch_path(spark, "nav_data_compact"))


def _refresh_master(spark: SparkSession, d: str) -> DataFrame:
    nav = fx.nav_p(spark, d)
    cut = F.lit(fx.MASTER_REFRESH_DATE).cast("date")
    path = scratch_path(spark, "scheme_master")
    nl.write_table(nl.scheme_master(nav.where(F.col("date") < cut)), path, mode="overwrite")
    nl.refresh_master(spark, path, nav.where(F.col("date") >= cut))
    return nl.read_table(spark, path).drop("last_date")


def _ingest_backfill_master(spark: SparkSession, d: str) -> DataFrame:
    """Newer half first, then the older half under older names: the master must not go back."""
    nav = with_partition_columns(fx.nav_p(spark, d))
    cut = F.lit(fx.MASTER_REFRESH_DATE).cast("date")
    path, master = scratch_path(spark, "nav_data"), scratch_path(spark, "scheme_master")
    nl.ingest_nav(nav.where(F.col("date") >= cut), path, master, load_id=1)
    older = nav.where(F.col("date") < cut).withColumn("scheme_name", F.concat(F.lit("OLD "), "scheme_name"))
    nl.ingest_nav(older, path, master, load_id=2)
    return nl.read_table(spark, master).drop("last_date")


def _ingest_corrected_prices(spark: SparkSession, d: str) -> DataFrame:
    """One quarter is loaded again with doubled NAVs: readers see the corrections, the other rows once."""
    nav = with_partition_columns(fx.nav_s(spark, d))
    path = scratch_path(spark, "nav_data")
    nl.ingest_nav(nav, path, load_id=1)
    again = nav.where(F.col("date").between(RANGE_START, RANGE_END))
    half = F.when(F.col("date") < CORRECTED_BEFORE, F.col("nav") * 2).otherwise(F.col("nav"))
    nl.ingest_nav(again.withColumn("nav", half), path, load_id=2)
    return nl.nav_as_of(nl.read_table(spark, path)).select("scheme_code", "scheme_name", "date", "nav", "load_id")


def _ingest_retry_master(spark: SparkSession, d: str) -> DataFrame:
    """A load that broke off between append and refresh is run again."""
    nav = with_partition_columns(fx.nav_s(spark, d))
    path, master = scratch_path(spark, "nav_data"), scratch_path(spark, "scheme_master")
    nl.ingest_nav(nav, path, None, load_id=1)
    nl.ingest_nav(nav, path, master, load_id=1)
    return nl.read_table(spark, master).drop("last_date")


def _follow_landing(spark: SparkSession, d: str) -> DataFrame:
    from navlib.streaming import follow_landing

    landing, nav_path = scratch_path(spark, "landing"), scratch_path(spark, "nav_data")
    fx.feed_lines(spark, d).write.mode("overwrite").text(landing)
    follow_landing(spark, landing, nav_path, checkpoint_location=scratch_path(spark, "stream")).awaitTermination()
    return nl.read_table(spark, nav_path).drop("load_id", "loaded_at")


def _older_master(spark: SparkSession, d: str) -> DataFrame:
    nav = fx.nav_p(spark, d)
    return nl.scheme_master(nav.where(F.col("date") < F.lit(fx.MASTER_REFRESH_DATE).cast("date")))


def _with_newest(spark: SparkSession, d: str) -> DataFrame:
    """nav_p ingested in two loads, the older one last, with the table of newest rows kept beside it."""
    nav = with_partition_columns(fx.nav_p(spark, d))
    cut = F.lit(fx.MASTER_REFRESH_DATE).cast("date")
    path, newest = scratch_path(spark, "nav_data"), scratch_path(spark, "newest_nav")
    nl.ingest_nav(nav.where(F.col("date") >= cut), path, load_id=1, newest_path=newest)
    nl.ingest_nav(nav.where(F.col("date") < cut), path, load_id=2, newest_path=newest)
    return nl.read_newest(spark, newest)


def _newest_nav(spark: SparkSession, d: str) -> DataFrame:
    """Two loads, then the last quarter again with doubled NAVs."""
    nav = with_partition_columns(fx.nav_s(spark, d))
    cut = F.lit(fx.MASTER_REFRESH_DATE).cast("date")
    path, newest = scratch_path(spark, "nav_data"), scratch_path(spark, "newest_nav")
    nl.ingest_nav(nav.where(F.col("date") >= cut), path, load_id=1, newest_path=newest)
    nl.ingest_nav(nav.where(F.col("date") < cut), path, load_id=2, newest_path=newest)
    again = nav.where(F.col("date") >= LAST_QUARTER).withColumn("nav", F.col("nav") * 2)
    nl.ingest_nav(again, path, load_id=3, newest_path=newest)
    return nl.read_newest(spark, newest).select("scheme_code", "scheme_name", "fund_house", "nav", "date", "load_id")


def _ingest_redelivered(spark: SparkSession, d: str) -> DataFrame:
    """A feed, one corrected quarter, the first feed again: its values win back in the corrected months, the others are skipped."""
    nav = with_partition_columns(fx.nav_s(spark, d))
    path = scratch_path(spark, "nav_data")
    nl.ingest_nav(nav, path, load_id=1)
    again = nav.where(F.col("date").between(RANGE_START, RANGE_END))
    nl.ingest_nav(again.withColumn("nav", F.col("nav") * 2), path, load_id=2)
    nl.ingest_nav(nav, path, load_id=3)
    return nl.read_table(spark, path).select("scheme_code", "scheme_name", "date", "nav", "load_id")


def _month_states(spark: SparkSession, nav: DataFrame) -> DataFrame:
    """The states of ``nav`` written in two turns, the second for the months from MASTER_REFRESH_DATE on."""
    path, states = scratch_path(spark, "nav_data"), scratch_path(spark, "month_states")
    nl.write_table(with_partition_columns(nav), path, ["year", "month"], "overwrite")
    stored = nl.read_table(spark, path)
    cut = int(fx.MASTER_REFRESH_DATE[:4])
    months = [(r.year, r.month) for r in stored.select("year", "month").distinct().collect()]
    monthly.refresh_month_states(spark, states, stored, [m for m in months if m[0] < cut])
    return monthly.refresh_month_states(spark, states, stored, [m for m in months if m[0] >= cut])


def _anomalies_by_month(spark: SparkSession, d: str) -> DataFrame:
    nav = fx.nav_s(spark, d)
    return monthly.anomaly_summary(_month_states(spark, nav), nav)


def _by_month(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: report(monthly.merged_states(_month_states(s, fx.nav_p(s, d))))


def _corr_args() -> dict:
    return {"codes": "all", "since": None, "min_overlap": MIN_OVERLAP}


QUERIES: dict[str, Query] = {
    # sources, sinks, ingest
    "parse_nav_text": lambda s, d: nl.parse_nav_text(fx.feed_lines(s, d)),
    "write_table": _write_table,
    "read_table": _read_table,
    "nav_as_of": lambda s, d: nl.nav_as_of(fx.nav_ticks(s, d), load_id=3, tie_cols=("tie", "nav")),
    "ingest_nav": _ingest,
    "ingest_backfill_master": _ingest_backfill_master,
    "ingest_corrected_prices": _ingest_corrected_prices,
    "ingest_retry_master": _ingest_retry_master,
    "ingest_redelivered": _ingest_redelivered,
    "newest_nav": _newest_nav,
    "scheme_master": lambda s, d: nl.scheme_master(fx.nav_s(s, d)),
    "refresh_master": _refresh_master,
    "deduplicate_nav": lambda s, d: nl.deduplicate_nav(fx.nav_ticks(s, d)),
    "follow_landing": _follow_landing,
    "compact_table": _compact,
    "table_profile": lambda s, d: nl.table_profile(s.read.parquet(_stored_nav(s, d))),
    "table_partitions": lambda s, d: nl.table_partitions(s.read.parquet(_stored_nav(s, d))),
    "table_profile_stored": lambda s, d: nl.stored_profile(s, _stored_nav(s, d)),
    "table_partitions_stored": lambda s, d: nl.stored_partitions(s, _stored_nav(s, d)),
    "nav_range_stored": lambda s, d: nl.stored_range(s, _stored_nav(s, d)),
    "latest_nav_date_stored": lambda s, d: nl.stored_latest_date(s, _stored_nav(s, d)),
    # lookups
    "nav_on_date": lambda s, d: nl.nav_on_date(fx.nav_s(s, d), ON_DATE),
    "nav_between": lambda s, d: nl.nav_between(fx.nav_s(s, d), RANGE_START, RANGE_END),
    "search_schemes": lambda s, d: nl.search_schemes(_older_master(s, d), KEYWORD, nav=fx.nav_p(s, d)),
    "schemes_by_fund_house": lambda s, d: nl.schemes_by_fund_house(_older_master(s, d), HOUSE_KEYWORD, nav=fx.nav_p(s, d)),
    "schemes_by_category": lambda s, d: nl.schemes_by_category(_older_master(s, d), KEYWORD, nav=fx.nav_p(s, d)),
    "scheme_details": lambda s, d: nl.scheme_details(_older_master(s, d), fx.nav_p(s, d)),
    "available_dates": lambda s, d: nl.available_dates(fx.nav_s(s, d)),
    "latest_nav_date": lambda s, d: nl.latest_nav_date(fx.nav_s(s, d)),
    "fund_houses": lambda s, d: nl.fund_houses(_older_master(s, d), fx.nav_p(s, d)),
    # lookups that read the maintained table of newest rows instead of NAV
    "search_schemes_newest": lambda s, d: nl.search_schemes(_older_master(s, d), KEYWORD, newest=_with_newest(s, d)),
    "schemes_by_fund_house_newest": lambda s, d: nl.schemes_by_fund_house(_older_master(s, d), HOUSE_KEYWORD, newest=_with_newest(s, d)),
    "schemes_by_category_newest": lambda s, d: nl.schemes_by_category(_older_master(s, d), KEYWORD, newest=_with_newest(s, d)),
    "scheme_details_newest": lambda s, d: nl.scheme_details(_older_master(s, d), newest=_with_newest(s, d)),
    "fund_houses_newest": lambda s, d: nl.fund_houses(_older_master(s, d), newest=_with_newest(s, d)),
    # summary, quality, duplicates
    "nav_summary": lambda s, d: nl.nav_summary(fx.nav_s(s, d), AS_OF),
    "dq_null_checks": lambda s, d: nl.dq_null_checks(fx.nav_ticks(s, d)),
    "dq_invalid_nav": lambda s, d: nl.dq_invalid_nav(fx.nav_ticks(s, d)),
    "dq_duplicates": lambda s, d: nl.dq_duplicates(fx.nav_ticks(s, d)),
    "dq_date_consistency": lambda s, d: nl.dq_date_consistency(fx.nav_ticks(s, d)),
    "dq_code_format": lambda s, d: nl.dq_code_format(fx.nav_ticks(s, d)),
    "dq_overall": lambda s, d: nl.dq_overall(fx.nav_ticks(s, d)),
    "duplicate_codes": lambda s, d: nl.duplicate_codes(fx.master_renamed(s, d)),
    "similar_names": lambda s, d: nl.similar_names(fx.master_p(s, d)),
    "similar_name_members": lambda s, d: nl.similar_name_members(fx.master_p(s, d)),
    "duplicate_names": lambda s, d: nl.duplicate_names(fx.master_p(s, d)),
    "duplicate_summary": lambda s, d: nl.duplicate_summary(fx.master_p(s, d)),
    # returns and performance
    "daily_returns": lambda s, d: nl.daily_returns(fx.nav_s(s, d)),
    "period_returns": lambda s, d: nl.period_returns(fx.nav_s(s, d), PERIODS),
    "return_stats": lambda s, d: nl.return_stats(nl.daily_returns(fx.nav_s(s, d))),
    "scheme_performance": lambda s, d: nl.scheme_performance(fx.nav_s(s, d), PERIODS),
    "compare_schemes": lambda s, d: nl.compare_schemes(fx.nav_s(s, d), None, PERIOD),
    "compare_statistics": lambda s, d: nl.compare_statistics(nl.compare_schemes(fx.nav_s(s, d), None, PERIOD)),
    "compare_summary": lambda s, d: nl.compare_summary(nl.compare_schemes(fx.nav_s(s, d), None, PERIOD)),
    "top_performers": lambda s, d: nl.top_performers(fx.nav_s(s, d), period=PERIOD, limit=TOP_LIMIT, sort_by="return"),
    "top_performers_by_volatility": lambda s, d: nl.top_performers(
        fx.nav_s(s, d), period=PERIOD, limit=TOP_LIMIT, sort_by="volatility"
    ),
    "top_performers_by_risk_adjusted": lambda s, d: nl.top_performers(
        fx.nav_s(s, d), period=PERIOD, limit=TOP_LIMIT, sort_by="risk_adjusted"
    ),
    "top_performers_in_category": lambda s, d: nl.top_performers(
        fx.nav_p(s, d), fx.master_p(s, d), category=KEYWORD, period=PERIOD, limit=TOP_LIMIT, sort_by="return"
    ),
    "top_performer_statistics": lambda s, d: nl.top_performer_statistics(
        nl.operators.returns.period_performance(fx.nav_s(s, d), PERIOD)
    ),
    # risk
    "basic_volatility": lambda s, d: nl.basic_volatility(fx.nav_p(s, d)),
    "rolling_volatility": lambda s, d: nl.rolling_volatility(fx.nav_s(s, d, by_scheme=True), ROLLING_WINDOW),
    "downside_risk": lambda s, d: nl.downside_risk(fx.nav_p(s, d)),
    "upside_potential": lambda s, d: nl.upside_potential(fx.nav_p(s, d)),
    "risk_statistics": lambda s, d: nl.risk_statistics(fx.nav_p(s, d)),
    "value_at_risk": lambda s, d: nl.value_at_risk(fx.nav_p(s, d)),
    "volatility_regime": lambda s, d: nl.volatility_regime(fx.nav_p(s, d)),
    "volatility_regime_compounded": lambda s, d: nl.volatility_regime(fx.nav_c(s, d)),
    # risk and unchanged runs from month states
    "return_stats_monthly": lambda s, d: monthly.return_stats(monthly.merged_states(_month_states(s, fx.nav_s(s, d)))),
    "basic_volatility_monthly": _by_month(monthly.basic_volatility),
    "downside_risk_monthly": _by_month(monthly.downside_risk),
    "upside_potential_monthly": _by_month(monthly.upside_potential),
    "risk_statistics_monthly": _by_month(monthly.risk_statistics),
    "volatility_regime_monthly": _by_month(monthly.volatility_regime),
    "stale_nav_monthly": lambda s, d: monthly.stale_nav(_month_states(s, fx.nav_stale(s, d))),
    "anomaly_summary_monthly": _anomalies_by_month,
    # anomalies
    "extreme_returns": lambda s, d: nl.extreme_returns(fx.nav_s(s, d)),
    "extreme_returns_by_scheme": lambda s, d: nl.extreme_returns(fx.nav_s(s, d), scope="scheme"),
    "nav_jumps": lambda s, d: nl.nav_jumps(fx.nav_s(s, d)),
    "stale_nav": lambda s, d: nl.stale_nav(fx.nav_stale(s, d)),
    "invalid_nav_rows": lambda s, d: nl.invalid_nav_rows(fx.nav_s(s, d)),
    "anomaly_summary": lambda s, d: nl.anomaly_summary(fx.nav_s(s, d)),
    # correlation
    "most_observed_schemes": lambda s, d: nl.most_observed_schemes(fx.nav_s(s, d), None, MIN_OVERLAP, TOP_K),
    "most_observed_since": lambda s, d: nl.most_observed_schemes(fx.nav_s(s, d), SINCE, MIN_OVERLAP, TOP_K),
    "returns_matrix": lambda s, d: nl.returns_matrix(fx.nav_t(s, d), **_corr_args()),
    "data_availability": lambda s, d: nl.data_availability(fx.nav_t(s, d), **_corr_args()),
    "correlation_matrix": lambda s, d: nl.correlation_matrix(fx.nav_t(s, d), **_corr_args()),
    "notable_pairs": lambda s, d: nl.notable_pairs(fx.nav_t(s, d), **_corr_args()),
    "notable_pairs_compounded": lambda s, d: nl.notable_pairs(fx.nav_m(s, d), **_corr_args()),
    "correlation_statistics": lambda s, d: nl.correlation_statistics(fx.nav_t(s, d), **_corr_args()),
    "correlation_statistics_compounded": lambda s, d: nl.correlation_statistics(fx.nav_m(s, d), **_corr_args()),
    "diversification_insights": lambda s, d: nl.diversification_insights(fx.nav_t(s, d), **_corr_args()),
    "diversification_insights_compounded": lambda s, d: nl.diversification_insights(fx.nav_m(s, d), **_corr_args()),
    # over the dense daily series of every supplier
    "returns_matrix_all": lambda s, d: nl.returns_matrix(fx.nav_d(s, d), **_corr_args()),
    "data_availability_all": lambda s, d: nl.data_availability(fx.nav_s(s, d), **_corr_args()),
    "correlation_matrix_all": lambda s, d: nl.correlation_matrix(fx.nav_d(s, d), **_corr_args()),
    "notable_pairs_all": lambda s, d: nl.notable_pairs(fx.nav_d(s, d), **_corr_args()),
    "high_correlation_pairs": lambda s, d: nl.high_correlation_pairs(fx.nav_d(s, d), **_corr_args()),
    "correlation_statistics_all": lambda s, d: nl.correlation_statistics(fx.nav_d(s, d), **_corr_args()),
    "diversification_insights_all": lambda s, d: nl.diversification_insights(fx.nav_d(s, d), **_corr_args()),
}
