"""navlib — daily fund NAV analytics as Spark DataFrame operators.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame; the work runs as Spark jobs keyed by ``scheme_code`` so one call
covers every scheme at once.
"""

from navlib.sources.feed import parse_nav_text, read_feed_lines
from navlib.sources.store import (
    compact_table,
    compact_tables,
    deduplicate_nav,
    ingest_nav,
    nav_as_of,
    nav_range,
    read_newest,
    read_table,
    refresh_master,
    refresh_newest,
    stored_latest_date,
    stored_partitions,
    stored_profile,
    stored_range,
    table_partitions,
    table_profile,
    table_schema,
    write_table,
)
from navlib.operators.master import (
    available_dates,
    fund_houses,
    latest_nav,
    latest_nav_date,
    nav_between,
    nav_on_date,
    scheme_details,
    scheme_directory,
    scheme_master,
    schemes_by_category,
    schemes_by_fund_house,
    search_schemes,
)
from navlib.operators.quality import (
    dq_code_format,
    dq_date_consistency,
    dq_duplicates,
    dq_invalid_nav,
    dq_null_checks,
    dq_overall,
    duplicate_codes,
    duplicate_names,
    duplicate_summary,
    nav_summary,
    similar_name_members,
    similar_names,
)
from navlib.operators.returns import (
    compare_schemes,
    compare_statistics,
    compare_summary,
    current_rows,
    daily_returns,
    period_performance,
    period_returns,
    return_stats,
    scheme_performance,
    top_performer_statistics,
    top_performers,
)
from navlib.operators.risk import (
    analysed_returns,
    basic_volatility,
    downside_risk,
    risk_statistics,
    rolling_volatility,
    upside_potential,
    value_at_risk,
    volatility_regime,
)
from navlib.operators.anomaly import (
    analysed_rows,
    anomaly_summary,
    extreme_returns,
    invalid_nav_rows,
    nav_jumps,
    stale_nav,
)
from navlib.operators.correlation import (
    correlation_matrix,
    correlation_statistics,
    data_availability,
    diversification_insights,
    high_correlation_pairs,
    most_observed_schemes,
    notable_pairs,
    returns_matrix,
    returns_matrix_wide,
)

__all__ = [name for name in dir() if not name.startswith("_")]
