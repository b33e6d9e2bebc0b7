"""DuckDB oracle SQL for every registered query (same views, same parameters).

Display rounding uses DuckDB ``ROUND``, which rounds the scaled binary value
half away from zero: the same rule as ``navlib.functions.stats.half_up``.
"""

from __future__ import annotations

from navlib.plans import registry as R
from navlib.sources.fixtures import MASTER_REFRESH_DATE, with_fixtures

_YM = "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
_NAV_COLS = f"scheme_code, scheme_name, nav, date, fund_house, {_YM}"
_STORED = f"SELECT scheme_code, scheme_name, fund_house, date, nav, {_YM} FROM nav_s"


def _periods_values(periods) -> str:
    return ", ".join(f"({p})" for p in periods)


def _returns_cte(view: str) -> str:
    return f"""b AS (
  SELECT scheme_code, scheme_name, date, nav,
         nav / LAG(nav) OVER w - 1 AS r,
         ROW_NUMBER() OVER w AS pos,
         COUNT(*) OVER (PARTITION BY scheme_code) AS n
  FROM {view} WINDOW w AS (PARTITION BY scheme_code ORDER BY date))"""


def _perf_ctes(view: str, periods) -> str:
    """CTEs b (returns), h (per scheme), perf (per scheme and period, unrounded)."""
    return f"""WITH {_returns_cte(view)},
h AS (
  SELECT scheme_code, arg_min(scheme_name, date) AS scheme_name, arg_max(nav, date) AS cur_nav,
         MAX(date) AS "current_date", COUNT(*) AS data_points,
         STDDEV_SAMP(r) AS sd, MAX(r) AS rmax, MIN(r) AS rmin, COUNT(r) AS nr,
         COUNT(*) FILTER (WHERE r > 0) AS positive_days, COUNT(*) FILTER (WHERE r < 0) AS negative_days
  FROM b GROUP BY scheme_code),
p AS (SELECT * FROM (VALUES {_periods_values(periods)}) t(period)),
s AS (SELECT b.scheme_code, p.period, b.date AS start_date, b.nav AS start_nav
      FROM b JOIN p ON b.pos = GREATEST(b.n - p.period, 1)),
perf AS (
  SELECT h.*, s.period, s.start_date, s.start_nav,
         CASE WHEN h.data_points <= s.period THEN h.data_points - 1 ELSE s.period END AS days_actual
  FROM h JOIN s USING (scheme_code))"""


_GROWTH = "(POW(cur_nav / start_nav, 365.25::DOUBLE / days_actual) - 1) * 100"
_GROWTH_UNIT = f"CAST('1e' || CAST(FLOOR(LOG10(ABS({_GROWTH})) - 8) AS BIGINT) AS DOUBLE)"

_PERIOD_COLS = f"""ROUND(cur_nav - start_nav, 4) AS absolute_return,
  ROUND((cur_nav - start_nav) / start_nav * 100, 2) AS percentage_return,
  CASE WHEN days_actual > 0 AND cur_nav / start_nav >= 0
       THEN CASE WHEN ABS({_GROWTH}) < 1e6 THEN ROUND({_GROWTH}, 2)
            ELSE ROUND({_GROWTH} / {_GROWTH_UNIT}) * {_GROWTH_UNIT} END END AS annualized_return,
  start_date, ROUND(start_nav, 4) AS start_nav, CAST(days_actual AS BIGINT) AS days_actual"""

_STAT_COLS = """ROUND(sd, 6) AS daily_volatility, ROUND(sd * SQRT(252), 4) AS annualized_volatility,
  ROUND(rmax * 100, 2) AS max_daily_gain, ROUND(rmin * 100, 2) AS max_daily_loss,
  positive_days, negative_days, ROUND(CAST(positive_days AS DOUBLE) / nr * 100, 1) AS win_rate"""


def _period_perf(view: str, period: int) -> str:
    """CTE chain ending in pp: per-scheme figures of period_performance."""
    return f"""{_perf_ctes(view, [period])},
pp0 AS (
  SELECT scheme_code, scheme_name, ROUND(cur_nav, 4) AS current_nav, data_points,
         {_PERIOD_COLS}, {_STAT_COLS}
  FROM perf WHERE data_points >= 2),
pp AS (
  SELECT * EXCLUDE (annualized_volatility), annualized_volatility AS volatility,
         CASE WHEN annualized_volatility > 0 THEN ROUND(percentage_return / annualized_volatility, 2) ELSE 0.0 END
           AS risk_adjusted_return
  FROM pp0)"""


_COMPARE_COLS = """scheme_code, scheme_name, current_nav, absolute_return, percentage_return, annualized_return,
  volatility, win_rate, data_points, risk_adjusted_return"""


def _compare(view: str, period: int) -> str:
    return f"""{_period_perf(view, period)},
cmp AS (
  SELECT {_COMPARE_COLS},
    CASE WHEN (SELECT COUNT(*) FROM pp) >= 2 THEN ROW_NUMBER() OVER (ORDER BY percentage_return DESC NULLS LAST, scheme_code) END AS return_rank,
    CASE WHEN (SELECT COUNT(*) FROM pp) >= 2 THEN ROW_NUMBER() OVER (ORDER BY volatility ASC NULLS LAST, scheme_code) END AS risk_rank,
    CASE WHEN (SELECT COUNT(*) FROM pp) >= 2 THEN ROW_NUMBER() OVER (ORDER BY risk_adjusted_return DESC NULLS LAST, scheme_code) END AS risk_adjusted_rank,
    'ok' AS status
  FROM pp)"""


def _top(view: str, order: str, master: str | None = None, keyword: str | None = None) -> str:
    src = view
    pre = ""
    if master:
        pre = f"""cand AS (SELECT * FROM {view} WHERE scheme_code IN (
  SELECT scheme_code FROM {master} WHERE regexp_matches(scheme_name, '(?i).*{keyword}.*'))),
"""
        src = "cand"
    body = _period_perf(src, R.PERIOD)
    if pre:
        body = body.replace("WITH ", "WITH " + pre, 1)
    return f"""{body}
SELECT scheme_code, scheme_name, current_nav, percentage_return, annualized_return, volatility,
       risk_adjusted_return, win_rate, max_daily_gain, data_points,
       ROW_NUMBER() OVER (ORDER BY {order}, scheme_code) AS rank
FROM pp ORDER BY {order}, scheme_code LIMIT {R.TOP_LIMIT}"""


def _vol_base(view: str) -> str:
    return f"""WITH b0 AS (
  SELECT scheme_code, scheme_name, date, nav,
         nav / LAG(nav) OVER (PARTITION BY scheme_code ORDER BY date) - 1 AS r,
         COUNT(*) OVER (PARTITION BY scheme_code) AS n_rows
  FROM {view}),
a0 AS (SELECT * FROM b0 WHERE r IS NOT NULL AND scheme_name IS NOT NULL AND n_rows >= 30),
a AS (SELECT * FROM (SELECT *, COUNT(*) OVER (PARTITION BY scheme_code) AS nr FROM a0) WHERE nr >= 20)"""


def _anomaly_base(view: str) -> str:
    return f"""WITH r0 AS (
  SELECT scheme_code, scheme_name, date, nav,
         nav / LAG(nav) OVER (PARTITION BY scheme_code ORDER BY date) - 1 AS r
  FROM {view}),
a AS (SELECT * FROM r0 WHERE r IS NOT NULL AND scheme_name IS NOT NULL AND (SELECT COUNT(*) FROM {view}) >= 50),
st AS (SELECT AVG(r) AS m, STDDEV_SAMP(r) AS s FROM a),
mv AS (
  SELECT *, nav - LAG(nav) OVER w AS chg, (nav - LAG(nav) OVER w) / LAG(nav) OVER w AS pct,
         COALESCE(nav = LAG(nav) OVER w, false) AS same
  FROM a WINDOW w AS (PARTITION BY scheme_code ORDER BY date)),
g AS (
  SELECT *, SUM(CASE WHEN same THEN 0 ELSE 1 END)
              OVER (PARTITION BY scheme_code ORDER BY date ROWS UNBOUNDED PRECEDING) AS island
  FROM mv),
runs AS (SELECT scheme_code, island, COUNT(*) FILTER (WHERE same) AS run FROM g GROUP BY ALL),
per AS (SELECT scheme_code, MAX(run) AS mx FROM runs GROUP BY ALL),
nm AS (SELECT scheme_code, arg_min(scheme_name, date) AS scheme_name FROM a GROUP BY ALL)"""


def _corr_base(view: str) -> str:
    return f"""WITH c AS (
  SELECT scheme_code FROM {view} WHERE scheme_code IS NOT NULL GROUP BY scheme_code HAVING COUNT(*) >= {R.MIN_OVERLAP}),
rr AS (
  SELECT scheme_code, scheme_name, date, nav / LAG(nav) OVER (PARTITION BY scheme_code ORDER BY date) - 1 AS r
  FROM {view} WHERE scheme_code IN (SELECT scheme_code FROM c)),
rets AS (SELECT * FROM rr WHERE r IS NOT NULL AND scheme_name IS NOT NULL),
avail AS (
  SELECT scheme_code, COUNT(*) AS total_days, MIN(date) AS start_date, MAX(date) AS end_date,
         arg_min(scheme_name, date) AS scheme_name
  FROM rets GROUP BY ALL),
valid AS (SELECT scheme_code FROM avail WHERE total_days >= {R.MIN_OVERLAP}),
kept AS (SELECT * FROM rets WHERE scheme_code IN (SELECT scheme_code FROM valid)),
common AS (SELECT date FROM kept GROUP BY date HAVING COUNT(*) = (SELECT COUNT(*) FROM valid)),
mx AS (
  SELECT date, scheme_code, r FROM kept
  WHERE date IN (SELECT date FROM common)
    AND (SELECT COUNT(*) FROM valid) >= 2 AND (SELECT COUNT(*) FROM common) >= {R.MIN_OVERLAP}),
cm AS (
  SELECT a.scheme_code AS scheme1, b.scheme_code AS scheme2,
         CASE WHEN isnan(corr(a.r, b.r)) THEN NULL ELSE corr(a.r, b.r) END AS rho, COUNT(*) AS overlap_days
  FROM mx a JOIN mx b USING (date) GROUP BY ALL),
off AS (SELECT * FROM cm WHERE scheme1 <> scheme2 AND rho IS NOT NULL),
stats AS (SELECT COUNT(*) AS n, AVG(rho) AS mean_rho, MAX(rho) AS max_rho, MIN(rho) AS min_rho FROM off)"""


def _volatility_regime(view: str) -> str:
    return f"""{_vol_base(view)},
v AS (SELECT scheme_code, STDDEV_SAMP(r) * SQRT(252) AS vol FROM a GROUP BY scheme_code),
c AS (SELECT scheme_code, vol,
        CASE WHEN vol < 0.10 THEN 'Low Volatility' WHEN vol < 0.20 THEN 'Moderate Volatility'
             WHEN vol < 0.35 THEN 'High Volatility' ELSE 'Very High Volatility' END AS regime FROM v)
SELECT scheme_code, regime,
       CASE WHEN vol < 0.15 THEN 'Low' WHEN vol < 0.25 THEN 'Medium' ELSE 'High' END AS risk_level,
       'This scheme has ' || lower(regime) || ' with annualized volatility of ' || CAST(ROUND(vol * 100, 1) AS VARCHAR) || '%'
         AS interpretation
FROM c"""


def _data_availability(view: str) -> str:
    return f"""{_corr_base(view)}
SELECT c.scheme_code, avail.scheme_name, CAST(COALESCE(total_days, 0) AS BIGINT) AS total_days, start_date, end_date
FROM c LEFT JOIN avail USING (scheme_code)"""


def _correlation_matrix(view: str) -> str:
    return f"""{_corr_base(view)}
SELECT scheme1, scheme2, ROUND(rho, 4) + 0.0 AS correlation, overlap_days FROM cm"""


def _notable_pairs(view: str) -> str:
    return f"""{_corr_base(view)}
SELECT scheme1, a1.scheme_name AS scheme1_name, scheme2, a2.scheme_name AS scheme2_name, ROUND(rho, 4) + 0.0 AS correlation,
       CASE WHEN rho > 0.8 THEN 'high' ELSE 'low' END AS kind
FROM cm JOIN avail a1 ON a1.scheme_code = scheme1 JOIN avail a2 ON a2.scheme_code = scheme2
WHERE scheme1 < scheme2 AND (rho > 0.8 OR ABS(rho) < 0.3)"""


def _correlation_statistics(view: str) -> str:
    return f"""{_corr_base(view)}
SELECT ROUND(mean_rho, 4) AS average_correlation, ROUND(max_rho, 4) AS highest_correlation,
       ROUND(min_rho, 4) AS lowest_correlation, GREATEST(0.0, ROUND((1 - mean_rho) * 100, 1)) AS diversification_score
FROM stats WHERE n > 0"""


def _diversification_insights(view: str) -> str:
    return f"""{_corr_base(view)},
hi AS (SELECT COUNT(*) AS n_high FROM cm WHERE scheme1 < scheme2 AND rho > 0.8),
sc AS (SELECT GREATEST(0.0, ROUND((1 - mean_rho) * 100, 1)) AS score FROM stats WHERE n > 0)
SELECT CASE WHEN score > 70 THEN 'Excellent' WHEN score > 50 THEN 'Good' ELSE 'Poor' END AS portfolio_diversification,
       CASE WHEN n_high > (SELECT COUNT(*) FROM valid) THEN 'High' WHEN n_high > 2 THEN 'Medium' ELSE 'Low' END AS concentration_risk,
       CASE WHEN n_high > 3 THEN 'Consider reducing highly correlated holdings' ELSE 'Well diversified portfolio' END AS recommendation
FROM sc, hi"""


# every scheme of the older master or of NAV, with its newest NAV
_DIRECTORY = f"""WITH m AS (
  SELECT scheme_code, scheme_name, fund_house FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, scheme_name DESC, fund_house DESC) AS rn
    FROM nav_p WHERE date < DATE '{MASTER_REFRESH_DATE}') WHERE rn = 1),
l AS (
  SELECT scheme_code, scheme_name, fund_house, nav, date FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, nav DESC, scheme_name DESC, fund_house DESC) AS rn
    FROM nav_p) WHERE rn = 1),
dir AS (
  SELECT l.scheme_code, COALESCE(m.scheme_name, l.scheme_name) AS scheme_name, COALESCE(m.fund_house, l.fund_house) AS fund_house, l.nav, l.date
  FROM l LEFT JOIN m ON m.scheme_code = l.scheme_code)"""


ORACLES: dict[str, str] = {
    "parse_nav_text": with_fixtures(
        f"""SELECT scheme_code, scheme_name, FLOOR(nav * 100) / 100 AS nav, date, 'To be mapped' AS fund_house, {_YM}
FROM nav_s WHERE day(date) NOT IN (1, 2, 3, 4, 5)""",
        "nav_s",
    ),
    "write_table": with_fixtures(_STORED, "nav_s"),
    "read_table": with_fixtures(_STORED, "nav_s"),
    "nav_as_of": with_fixtures(
        """SELECT scheme_code, scheme_name, nav, date, fund_house, load_id, tie FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code, date ORDER BY load_id DESC, tie DESC, nav DESC NULLS LAST) AS rn
  FROM nav_ticks WHERE load_id <= 3) WHERE rn = 1""",
        "nav_ticks",
    ),
    "ingest_nav": with_fixtures(
        f"""SELECT scheme_code, scheme_name, FLOOR(nav * 100) / 100 AS nav, date, 'To be mapped' AS fund_house, {_YM},
       CAST(1 AS BIGINT) AS load_id
FROM nav_s WHERE day(date) NOT IN (1, 2, 3, 4, 5)""",
        "nav_s",
    ),
    "ingest_backfill_master": with_fixtures(
        f"""WITH a AS (
  SELECT scheme_code, date, fund_house,
         CASE WHEN date < DATE '{MASTER_REFRESH_DATE}' THEN 'OLD ' || scheme_name ELSE scheme_name END AS scheme_name FROM nav_p)
SELECT scheme_code, arg_max(scheme_name, date) AS scheme_name, arg_max(fund_house, date) AS fund_house FROM a GROUP BY scheme_code""",
        "nav_p",
    ),
    "ingest_corrected_prices": with_fixtures(
        f"""WITH c AS (
  SELECT *, date >= DATE '{R.RANGE_START}' AND date < DATE '{R.CORRECTED_BEFORE}' AND nav <> 0 AS changed FROM nav_s)
SELECT scheme_code, scheme_name, date, CASE WHEN changed THEN nav * 2 ELSE nav END AS nav,
       CAST(CASE WHEN changed THEN 2 ELSE 1 END AS BIGINT) AS load_id FROM c""",
        "nav_s",
    ),
    "ingest_retry_master": with_fixtures(
        "SELECT scheme_code, arg_max(scheme_name, date) AS scheme_name, arg_max(fund_house, date) AS fund_house FROM nav_s GROUP BY scheme_code",
        "nav_s",
    ),
    "scheme_master": with_fixtures(
        """SELECT scheme_code, scheme_name, fund_house FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, scheme_name DESC, fund_house DESC) AS rn
  FROM nav_s) WHERE rn = 1""",
        "nav_s",
    ),
    "compact_table": with_fixtures(_STORED, "nav_s"),
    "refresh_master": with_fixtures(
        f"""WITH old AS (
  SELECT scheme_code, scheme_name, fund_house FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, scheme_name DESC, fund_house DESC) AS rn
    FROM nav_p WHERE date < DATE '{MASTER_REFRESH_DATE}') WHERE rn = 1),
fresh AS (
  SELECT scheme_code, scheme_name, fund_house FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, scheme_name DESC, fund_house DESC) AS rn
    FROM nav_p WHERE date >= DATE '{MASTER_REFRESH_DATE}') WHERE rn = 1)
SELECT * FROM fresh
UNION ALL
SELECT * FROM old WHERE scheme_code NOT IN (SELECT scheme_code FROM fresh)""",
        "nav_p",
    ),
    "deduplicate_nav": with_fixtures(
        """SELECT scheme_code, date, scheme_name, nav, fund_house, load_id, tie FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code, date
           ORDER BY nav DESC, scheme_name DESC NULLS LAST, fund_house DESC NULLS LAST, load_id DESC, tie DESC) AS rn
  FROM nav_ticks WHERE scheme_code IS NOT NULL AND date IS NOT NULL AND nav IS NOT NULL) WHERE rn = 1""",
        "nav_ticks",
    ),
    "follow_landing": with_fixtures(
        f"""SELECT scheme_code, scheme_name, FLOOR(nav * 100) / 100 AS nav, date, 'To be mapped' AS fund_house, {_YM}
FROM nav_s WHERE day(date) NOT IN (1, 2, 3, 4, 5)""",
        "nav_s",
    ),
    "table_profile": with_fixtures(
        """SELECT CAST(7 AS BIGINT) AS column_count, COUNT(*) AS row_count,
       COUNT(DISTINCT year(date) * 100 + month(date)) AS partition_count FROM nav_s""",
        "nav_s",
    ),
    "table_partitions": with_fixtures(
        """SELECT printf('year=%d/month=%02d', year(date), month(date)) AS partition, COUNT(*) AS rows
FROM nav_s GROUP BY 1""",
        "nav_s",
    ),
    "nav_on_date": with_fixtures(f"SELECT {_NAV_COLS} FROM nav_s WHERE date = DATE '{R.ON_DATE}'", "nav_s"),
    "nav_between": with_fixtures(
        f"SELECT {_NAV_COLS} FROM nav_s WHERE date BETWEEN DATE '{R.RANGE_START}' AND DATE '{R.RANGE_END}'", "nav_s"
    ),
    "search_schemes": with_fixtures(
        f"""{_DIRECTORY}
SELECT * FROM dir WHERE regexp_matches(scheme_name, '(?i){R.KEYWORD}') OR regexp_matches(fund_house, '(?i){R.KEYWORD}')
ORDER BY scheme_code LIMIT 50""",
        "nav_p",
    ),
    "schemes_by_fund_house": with_fixtures(
        f"{_DIRECTORY} SELECT * FROM dir WHERE regexp_matches(fund_house, '(?i){R.HOUSE_KEYWORD}')", "nav_p"
    ),
    "schemes_by_category": with_fixtures(
        f"{_DIRECTORY} SELECT * FROM dir WHERE regexp_matches(scheme_name, '(?i){R.KEYWORD}')", "nav_p"
    ),
    "scheme_details": with_fixtures(
        f"""WITH m AS (
  SELECT scheme_code, scheme_name, fund_house FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, scheme_name DESC, fund_house DESC) AS rn
    FROM nav_p WHERE date < DATE '{MASTER_REFRESH_DATE}') WHERE rn = 1),
l AS (
  SELECT scheme_code, scheme_name, fund_house, nav, date FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC, nav DESC, scheme_name DESC, fund_house DESC) AS rn
    FROM nav_p) WHERE rn = 1)
SELECT COALESCE(m.scheme_code, l.scheme_code) AS scheme_code,
       CASE WHEN m.scheme_code IS NOT NULL THEN m.scheme_name ELSE l.scheme_name END AS scheme_name,
       CASE WHEN m.scheme_code IS NOT NULL THEN m.fund_house ELSE l.fund_house END AS fund_house,
       l.nav AS current_nav, l.date AS nav_date,
       CASE WHEN m.scheme_code IS NOT NULL THEN 'scheme_master' ELSE 'daily_nav' END AS data_source
FROM m FULL OUTER JOIN l ON m.scheme_code = l.scheme_code""",
        "nav_p",
    ),
    "available_dates": with_fixtures("SELECT DISTINCT date FROM nav_s", "nav_s"),
    "latest_nav_date": with_fixtures("SELECT MAX(date) AS latest_date FROM nav_s", "nav_s"),
    "fund_houses": with_fixtures(f"{_DIRECTORY} SELECT DISTINCT fund_house FROM dir", "nav_p"),
    "nav_summary": with_fixtures(
        f"""SELECT COUNT(*) AS total_schemes, COUNT(DISTINCT fund_house) AS total_fund_houses,
       ROUND(MIN(nav), 2) AS min_nav, ROUND(MAX(nav), 2) AS max_nav, ROUND(AVG(nav), 2) AS avg_nav,
       MIN(date) AS earliest_date, MAX(date) AS latest_date,
       CASE WHEN datediff('day', MAX(date), DATE '{R.AS_OF}') <= 1 THEN 'Current' ELSE 'Stale' END AS data_freshness
FROM nav_s""",
        "nav_s",
    ),
    "dq_null_checks": with_fixtures(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
       ROUND(CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / COUNT(*) * 100, 2) AS null_percentage FROM nav_ticks"""
            for c in ("scheme_code", "scheme_name", "nav", "date")
        ),
        "nav_ticks",
    ),
    "dq_invalid_nav": with_fixtures(
        """SELECT COUNT(*) FILTER (WHERE nav <= 0 OR nav > 10000) AS count,
       ROUND(CAST(COUNT(*) FILTER (WHERE nav <= 0 OR nav > 10000) AS DOUBLE) / COUNT(*) * 100, 2) AS percentage
FROM nav_ticks""",
        "nav_ticks",
    ),
    "dq_duplicates": with_fixtures(
        "SELECT scheme_code, date, COUNT(*) AS record_count FROM nav_ticks GROUP BY ALL HAVING COUNT(*) > 1",
        "nav_ticks",
    ),
    "dq_date_consistency": with_fixtures(
        "SELECT MIN(date) AS earliest, MAX(date) AS latest, COUNT(DISTINCT date) AS unique_dates FROM nav_ticks",
        "nav_ticks",
    ),
    "dq_code_format": with_fixtures(
        """SELECT COUNT(*) FILTER (WHERE NOT regexp_matches(scheme_code, '^[0-9]+$')) AS invalid_format_count,
       ROUND(CAST(COUNT(*) FILTER (WHERE NOT regexp_matches(scheme_code, '^[0-9]+$')) AS DOUBLE) / COUNT(*) * 100, 2) AS percentage
FROM nav_ticks""",
        "nav_ticks",
    ),
    "dq_overall": with_fixtures(
        """WITH t AS (
  SELECT COUNT(*) AS total_records,
         COUNT(*) FILTER (WHERE scheme_code IS NULL) + COUNT(*) FILTER (WHERE scheme_name IS NULL)
         + COUNT(*) FILTER (WHERE nav IS NULL) + COUNT(*) FILTER (WHERE date IS NULL)
         + COUNT(*) FILTER (WHERE nav <= 0 OR nav > 10000)
         + COUNT(*) FILTER (WHERE NOT regexp_matches(scheme_code, '^[0-9]+$'))
         + (SELECT COUNT(*) FROM (SELECT 1 FROM nav_ticks GROUP BY scheme_code, date HAVING COUNT(*) > 1)) AS total_issues
  FROM nav_ticks),
u AS (SELECT *, CASE WHEN total_records > 0 THEN GREATEST(0.0, ROUND(100 - CAST(total_issues AS DOUBLE) / total_records * 100, 2)) ELSE 0.0 END AS score FROM t)
SELECT score, total_records, CAST(total_issues AS BIGINT) AS total_issues,
       CASE WHEN score >= 95 THEN 'excellent' WHEN score >= 85 THEN 'good' ELSE 'needs_attention' END AS status
FROM u""",
        "nav_ticks",
    ),
    "duplicate_codes": with_fixtures(
        """WITH c AS (SELECT scheme_code, COUNT(*) AS count FROM master_renamed WHERE scheme_code IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1)
SELECT m.scheme_code, c.count, m.scheme_name FROM master_renamed m JOIN c USING (scheme_code)""",
        "master_renamed",
    ),
    "similar_names": with_fixtures(
        """WITH g AS (
  SELECT fund_house, regexp_replace(lower(scheme_name), '[ -]', '', 'g') AS norm, COUNT(*) AS members
  FROM master_p WHERE scheme_name IS NOT NULL GROUP BY ALL)
SELECT a.fund_house, a.norm AS name_norm_1, b.norm AS name_norm_2, a.members AS members_1, b.members AS members_2,
       CAST(CASE WHEN a.norm = b.norm THEN a.members * (a.members - 1) // 2 ELSE a.members * b.members END AS BIGINT) AS pair_count
FROM g a JOIN g b ON a.fund_house IS NOT DISTINCT FROM b.fund_house
 AND ((a.norm = b.norm AND a.members > 1)
      OR (length(b.norm) - length(a.norm) BETWEEN 1 AND 3 AND contains(b.norm, a.norm)))""",
        "master_p",
    ),
    "similar_name_members": with_fixtures(
        """WITH m AS (
  SELECT fund_house, regexp_replace(lower(scheme_name), '[ -]', '', 'g') AS norm, scheme_code, scheme_name
  FROM master_p WHERE scheme_name IS NOT NULL),
g AS (SELECT fund_house, norm, COUNT(*) AS members FROM m GROUP BY ALL),
pairs AS (
  SELECT a.fund_house, a.norm AS n1, b.norm AS n2
  FROM g a JOIN g b ON a.fund_house IS NOT DISTINCT FROM b.fund_house
   AND ((a.norm = b.norm AND a.members > 1)
        OR (length(b.norm) - length(a.norm) BETWEEN 1 AND 3 AND contains(b.norm, a.norm)))),
norms AS (SELECT fund_house, n1 AS norm FROM pairs UNION SELECT fund_house, n2 FROM pairs)
SELECT m.fund_house, m.norm AS name_norm, m.scheme_code, m.scheme_name
FROM m WHERE (m.fund_house, m.norm) IN (SELECT (fund_house, norm) FROM norms)""",
        "master_p",
    ),
    "duplicate_names": with_fixtures(
        """WITH c AS (SELECT scheme_name, COUNT(*) AS count, MIN(fund_house) AS fund_house FROM master_p
           WHERE scheme_name IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1)
SELECT m.scheme_name, c.count, m.scheme_code, c.fund_house FROM master_p m JOIN c USING (scheme_name)""",
        "master_p",
    ),
    "duplicate_summary": with_fixtures(
        """WITH g AS (
  SELECT fund_house, regexp_replace(lower(scheme_name), '[ -]', '', 'g') AS norm, COUNT(*) AS members
  FROM master_p WHERE scheme_name IS NOT NULL GROUP BY ALL),
pairs AS (
  SELECT CASE WHEN a.norm = b.norm THEN a.members * (a.members - 1) // 2 ELSE a.members * b.members END AS pc
  FROM g a JOIN g b ON a.fund_house IS NOT DISTINCT FROM b.fund_house
   AND ((a.norm = b.norm AND a.members > 1)
        OR (length(b.norm) - length(a.norm) BETWEEN 1 AND 3 AND contains(b.norm, a.norm)))),
t AS (SELECT
  (SELECT COUNT(*) FROM (SELECT scheme_code FROM master_p WHERE scheme_code IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1))
  + (SELECT COALESCE(SUM(pc), 0) FROM pairs)
  + (SELECT COUNT(*) FROM (SELECT scheme_name FROM master_p WHERE scheme_name IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1))
  AS total, (SELECT COUNT(*) FROM master_p) AS n)
SELECT CAST(total AS BIGINT) AS total_potential_duplicates, n AS total_schemes_analyzed,
       CASE WHEN n > 0 THEN ROUND(CAST(total AS DOUBLE) / n * 100, 2) ELSE 0.0 END AS duplicate_percentage,
       CASE WHEN total = 0 THEN 'clean' WHEN total <= 10 THEN 'needs_review' ELSE 'significant_issues' END AS status
FROM t""",
        "master_p",
    ),
    "daily_returns": with_fixtures(
        """SELECT scheme_code, scheme_name, date, nav,
       nav / LAG(nav) OVER (PARTITION BY scheme_code ORDER BY date) - 1 AS r FROM nav_s""",
        "nav_s",
    ),
    "period_returns": with_fixtures(
        f"""{_perf_ctes('nav_s', R.PERIODS)}
SELECT scheme_code, CAST(period AS INTEGER) AS period, {_PERIOD_COLS} FROM perf""",
        "nav_s",
    ),
    "return_stats": with_fixtures(
        f"""{_perf_ctes('nav_s', R.PERIODS)}
SELECT scheme_code, {_STAT_COLS} FROM h WHERE nr > 0""",
        "nav_s",
    ),
    "scheme_performance": with_fixtures(
        f"""{_perf_ctes('nav_s', R.PERIODS)}
SELECT scheme_code, scheme_name, ROUND(cur_nav, 4) AS current_nav, "current_date", data_points,
       CAST(period AS INTEGER) AS period, {_PERIOD_COLS}, {_STAT_COLS}
FROM perf WHERE data_points >= 2""",
        "nav_s",
    ),
    "compare_schemes": with_fixtures(
        f"""{_compare('nav_s', R.PERIOD)}
SELECT * FROM cmp""",
        "nav_s",
    ),
    "compare_statistics": with_fixtures(
        f"""{_compare('nav_s', R.PERIOD)}
SELECT MAX(percentage_return) AS highest_return, MIN(percentage_return) AS lowest_return,
       ROUND(AVG(percentage_return), 2) AS average_return,
       ROUND(MAX(percentage_return) - MIN(percentage_return), 2) AS return_spread,
       MAX(volatility) AS highest_volatility, MIN(volatility) AS lowest_volatility,
       ROUND(AVG(volatility), 4) AS average_volatility
FROM cmp WHERE status = 'ok' HAVING COUNT(*) >= 2""",
        "nav_s",
    ),
    "compare_summary": with_fixtures(
        f"""{_compare('nav_s', R.PERIOD)}
SELECT arg_min(scheme_code, return_rank) AS best_performer, arg_max(scheme_code, return_rank) AS worst_performer,
       arg_min(scheme_code, risk_rank) AS least_risky, arg_max(scheme_code, risk_rank) AS most_risky,
       arg_min(scheme_code, risk_adjusted_rank) AS best_risk_adjusted
FROM cmp WHERE return_rank IS NOT NULL HAVING COUNT(*) >= 2""",
        "nav_s",
    ),
    "top_performers": with_fixtures(_top("nav_s", "percentage_return DESC NULLS LAST"), "nav_s"),
    "top_performers_by_volatility": with_fixtures(_top("nav_s", "volatility ASC NULLS LAST"), "nav_s"),
    "top_performers_by_risk_adjusted": with_fixtures(_top("nav_s", "risk_adjusted_return DESC NULLS LAST"), "nav_s"),
    "top_performers_in_category": with_fixtures(
        _top("nav_p", "percentage_return DESC NULLS LAST", "master_p", R.KEYWORD), "nav_p", "master_p"
    ),
    "top_performer_statistics": with_fixtures(
        f"""{_period_perf('nav_s', R.PERIOD)},
ranked AS (SELECT percentage_return, ROW_NUMBER() OVER (ORDER BY percentage_return, scheme_code) AS rn,
                  COUNT(*) OVER () AS n FROM pp WHERE percentage_return IS NOT NULL)
SELECT COUNT(*) AS total_schemes_analyzed, ROUND(AVG(percentage_return), 2) AS average_return,
       ROUND((SELECT MAX(percentage_return) FROM ranked WHERE rn = n // 2 + 1), 2) AS median_return,
       MAX(percentage_return) AS top_return, MIN(percentage_return) AS bottom_return,
       ROUND(AVG(volatility) FILTER (WHERE volatility > 0), 4) AS average_volatility,
       MIN(volatility) FILTER (WHERE volatility > 0) AS lowest_volatility,
       MAX(volatility) FILTER (WHERE volatility > 0) AS highest_volatility
FROM pp""",
        "nav_s",
    ),
    "basic_volatility": with_fixtures(
        f"""{_vol_base('nav_p')}
SELECT scheme_code, arg_min(scheme_name, date) AS scheme_name, MIN(date) AS start_date, MAX(date) AS end_date,
       COUNT(*) AS total_days, ROUND(STDDEV_SAMP(r), 6) AS daily_volatility,
       ROUND(STDDEV_SAMP(r) * SQRT(5), 6) AS weekly_volatility, ROUND(STDDEV_SAMP(r) * SQRT(21), 5) AS monthly_volatility,
       ROUND(STDDEV_SAMP(r) * SQRT(252), 4) AS annualized_volatility
FROM a GROUP BY scheme_code""",
        "nav_p",
    ),
    "rolling_volatility": with_fixtures(
        f"""{_vol_base('nav_s')},
x AS (SELECT scheme_code, date,
             STDDEV_SAMP(r) OVER (PARTITION BY scheme_code ORDER BY date ROWS BETWEEN {R.ROLLING_WINDOW - 1} PRECEDING AND CURRENT ROW) * SQRT(252) AS v,
             ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date) AS k
      FROM a),
y AS (SELECT * FROM x WHERE k >= {R.ROLLING_WINDOW})
SELECT scheme_code, ROUND(arg_max(v, date), 4) AS current_rolling_vol, ROUND(AVG(v), 4) AS average_rolling_vol,
       ROUND(MIN(v), 4) AS min_rolling_vol, ROUND(MAX(v), 4) AS max_rolling_vol,
       ROUND(STDDEV_SAMP(v), 4) AS volatility_of_volatility
FROM y GROUP BY scheme_code""",
        "nav_s",
    ),
    "downside_risk": with_fixtures(
        f"""{_vol_base('nav_p')}
SELECT scheme_code, ROUND(STDDEV_SAMP(r) FILTER (WHERE r < 0) * SQRT(252), 4) AS downside_volatility,
       ROUND(CAST(COUNT(*) FILTER (WHERE r < 0) AS DOUBLE) / COUNT(*), 3) AS downside_frequency,
       ROUND(AVG(r) FILTER (WHERE r < 0) * 100, 2) AS average_down_day,
       ROUND(MIN(r) FILTER (WHERE r < 0) * 100, 2) AS worst_single_day
FROM a GROUP BY scheme_code HAVING COUNT(*) FILTER (WHERE r < 0) > 0""",
        "nav_p",
    ),
    "upside_potential": with_fixtures(
        f"""{_vol_base('nav_p')}
SELECT scheme_code, ROUND(STDDEV_SAMP(r) FILTER (WHERE r > 0) * SQRT(252), 4) AS upside_volatility,
       ROUND(CAST(COUNT(*) FILTER (WHERE r > 0) AS DOUBLE) / COUNT(*), 3) AS upside_frequency,
       ROUND(AVG(r) FILTER (WHERE r > 0) * 100, 2) AS average_up_day,
       ROUND(MAX(r) FILTER (WHERE r > 0) * 100, 2) AS best_single_day
FROM a GROUP BY scheme_code HAVING COUNT(*) FILTER (WHERE r > 0) > 0""",
        "nav_p",
    ),
    "risk_statistics": with_fixtures(
        f"""{_vol_base('nav_p')},
m AS (SELECT scheme_code, AVG(r) AS mean, STDDEV_SAMP(r) AS sd, skewness(r) AS sk, kurtosis(r) AS ku FROM a GROUP BY scheme_code)
SELECT scheme_code, ROUND(mean * 100, 3) AS mean_daily_return, ROUND(sk, 3) AS return_skewness,
       ROUND(ku, 3) AS return_kurtosis,
       CASE WHEN sd > 0 THEN ROUND(mean / sd, 3) ELSE 0.0 END AS sharpe_ratio_approx,
       CASE WHEN mean <> 0 THEN ROUND(sd / ABS(mean), 2) ELSE 'inf'::DOUBLE END AS coefficient_of_variation
FROM m""",
        "nav_p",
    ),
    "value_at_risk": with_fixtures(
        f"""{_vol_base('nav_p')},
q AS (SELECT *, quantile_cont(r, 0.05) OVER (PARTITION BY scheme_code) AS q05 FROM a)
SELECT scheme_code, ROUND(ANY_VALUE(q05) * 100, 2) AS var_95_percent,
       ROUND(quantile_cont(r, 0.01) * 100, 2) AS var_99_percent,
       ROUND(AVG(r) FILTER (WHERE r <= q05) * 100, 2) AS expected_shortfall_95,
       ROUND(MIN(r) * 100, 2) AS max_drawdown_single_day
FROM q GROUP BY scheme_code""",
        "nav_p",
    ),
    "volatility_regime": with_fixtures(_volatility_regime("nav_p"), "nav_p"),
    "volatility_regime_compounded": with_fixtures(_volatility_regime("nav_c"), "nav_c"),
    "extreme_returns": with_fixtures(
        f"""{_anomaly_base('nav_s')}
SELECT scheme_code, scheme_name, date, ROUND(nav, 4) AS nav, ROUND(r * 100, 2) AS daily_return,
       ROUND(ABS(r - m) / s, 2) AS std_deviations,
       CASE WHEN r > 0 THEN 'extreme_positive' ELSE 'extreme_negative' END AS anomaly_type
FROM (SELECT *, AVG(r) OVER () AS m, STDDEV_SAMP(r) OVER () AS s FROM a) WHERE r > m + 3.0 * s OR r < m - 3.0 * s""",
        "nav_s",
    ),
    "extreme_returns_by_scheme": with_fixtures(
        f"""{_anomaly_base('nav_s')}
SELECT scheme_code, scheme_name, date, ROUND(nav, 4) AS nav, ROUND(r * 100, 2) AS daily_return,
       ROUND(ABS(r - m) / s, 2) AS std_deviations,
       CASE WHEN r > 0 THEN 'extreme_positive' ELSE 'extreme_negative' END AS anomaly_type
FROM (SELECT *, AVG(r) OVER (PARTITION BY scheme_code) AS m, STDDEV_SAMP(r) OVER (PARTITION BY scheme_code) AS s FROM a)
WHERE r > m + 3.0 * s OR r < m - 3.0 * s""",
        "nav_s",
    ),
    "nav_jumps": with_fixtures(
        f"""{_anomaly_base('nav_s')}
SELECT scheme_code, scheme_name, date, ROUND(nav - chg, 4) AS nav_before, ROUND(nav, 4) AS nav_after,
       ROUND(chg, 4) AS nav_change, ROUND(pct * 100, 2) AS nav_change_percent, ABS(pct) > 0.5 AS possible_data_error
FROM mv WHERE ABS(pct) > 0.2""",
        "nav_s",
    ),
    "stale_nav": with_fixtures(
        f"""{_anomaly_base('nav_stale')}
SELECT per.scheme_code, nm.scheme_name, 'stale_nav' AS pattern_type, mx AS max_consecutive_unchanged,
       'NAV unchanged for ' || mx || ' consecutive days' AS description
FROM per JOIN nm USING (scheme_code) WHERE mx >= 5""",
        "nav_stale",
    ),
    "invalid_nav_rows": with_fixtures(
        f"""{_anomaly_base('nav_s')}
SELECT scheme_code, scheme_name, date, nav, 'invalid_nav_value' AS issue_type,
       'NAV value ' || CAST(nav AS VARCHAR) || ' is outside reasonable range' AS description
FROM a WHERE nav <= 0 OR nav > 10000""",
        "nav_s",
    ),
    "anomaly_summary": with_fixtures(
        f"""{_anomaly_base('nav_s')},
cnt AS (SELECT
  (SELECT COUNT(*) FROM a, st WHERE r > m + 3.0 * s OR r < m - 3.0 * s) AS e,
  (SELECT COUNT(*) FROM mv WHERE ABS(pct) > 0.2) AS j,
  (SELECT COUNT(*) FROM per WHERE mx >= 5) AS p,
  (SELECT COUNT(*) FROM a WHERE nav <= 0 OR nav > 10000) AS q,
  (SELECT COUNT(*) FROM a) AS n)
SELECT n AS total_data_points_analyzed, (SELECT COUNT(DISTINCT scheme_code) FROM a) AS unique_schemes_analyzed,
       (SELECT MIN(date) FROM a) AS start, (SELECT MAX(date) FROM a) AS "end",
       e AS extreme_returns, j AS nav_jumps, p AS suspicious_patterns, q AS data_quality_issues,
       e + j + p + q AS total_anomalies,
       ROUND(CAST(e + j + p + q AS DOUBLE) / n * 100, 3) AS anomaly_rate,
       GREATEST(0.0, ROUND(100 - CAST(e + j + p + q AS DOUBLE) / n * 100, 1)) AS data_health_score
FROM cnt WHERE n > 0""",
        "nav_s",
    ),
    "most_observed_since": with_fixtures(
        f"""SELECT scheme_code, COUNT(*) AS data_points, arg_min(scheme_name, date) AS scheme_name
FROM nav_s WHERE scheme_code IS NOT NULL AND date >= DATE '{R.SINCE}' GROUP BY scheme_code HAVING COUNT(*) >= {R.MIN_OVERLAP}
ORDER BY data_points DESC, scheme_code LIMIT {R.TOP_K}""",
        "nav_s",
    ),
    "most_observed_schemes": with_fixtures(
        f"""SELECT scheme_code, COUNT(*) AS data_points, arg_min(scheme_name, date) AS scheme_name
FROM nav_s WHERE scheme_code IS NOT NULL GROUP BY scheme_code HAVING COUNT(*) >= {R.MIN_OVERLAP}
ORDER BY data_points DESC, scheme_code LIMIT {R.TOP_K}""",
        "nav_s",
    ),
    "newest_nav": with_fixtures(
        f"""SELECT scheme_code, scheme_name, fund_house, CASE WHEN date >= DATE '{R.LAST_QUARTER}' THEN nav * 2 ELSE nav END AS nav, date,
       CAST(CASE WHEN date >= DATE '{R.LAST_QUARTER}' THEN 3 WHEN date >= DATE '{MASTER_REFRESH_DATE}' THEN 1 ELSE 2 END AS BIGINT) AS load_id
FROM nav_s QUALIFY ROW_NUMBER() OVER (PARTITION BY scheme_code ORDER BY date DESC) = 1""",
        "nav_s",
    ),
    "ingest_redelivered": with_fixtures(
        f"""SELECT scheme_code, scheme_name, date, nav, CAST(load AS BIGINT) AS load_id
FROM (SELECT *, 1 AS load FROM nav_s UNION ALL
      SELECT scheme_code, scheme_name, fund_house, date, nav * 2 AS nav, 2 AS load FROM nav_s
      WHERE date BETWEEN DATE '{R.RANGE_START}' AND DATE '{R.RANGE_END}' UNION ALL
      SELECT *, 3 AS load FROM nav_s WHERE date BETWEEN DATE '{R.RANGE_START}' AND DATE '{R.RANGE_END}')""",
        "nav_s",
    ),
    "returns_matrix": with_fixtures(f"{_corr_base('nav_t')}\nSELECT * FROM mx", "nav_t"),
    "returns_matrix_all": with_fixtures(f"{_corr_base('nav_d')}\nSELECT * FROM mx", "nav_d"),
    "data_availability": with_fixtures(_data_availability("nav_t"), "nav_t"),
    "data_availability_all": with_fixtures(_data_availability("nav_s"), "nav_s"),
    "correlation_matrix": with_fixtures(_correlation_matrix("nav_t"), "nav_t"),
    "correlation_matrix_all": with_fixtures(_correlation_matrix("nav_d"), "nav_d"),
    "notable_pairs_all": with_fixtures(_notable_pairs("nav_d"), "nav_d"),
    "high_correlation_pairs": with_fixtures(f"{_notable_pairs('nav_d')} AND rho > 0.8", "nav_d"),
    "correlation_statistics_all": with_fixtures(_correlation_statistics("nav_d"), "nav_d"),
    "diversification_insights_all": with_fixtures(_diversification_insights("nav_d"), "nav_d"),
    "notable_pairs": with_fixtures(_notable_pairs("nav_t"), "nav_t"),
    "notable_pairs_compounded": with_fixtures(_notable_pairs("nav_m"), "nav_m"),
    "correlation_statistics": with_fixtures(_correlation_statistics("nav_t"), "nav_t"),
    "correlation_statistics_compounded": with_fixtures(_correlation_statistics("nav_m"), "nav_m"),
    "diversification_insights": with_fixtures(_diversification_insights("nav_t"), "nav_t"),
    "diversification_insights_compounded": with_fixtures(_diversification_insights("nav_m"), "nav_m"),
}
ORACLES["nav_range_stored"] = with_fixtures(
    """SELECT COUNT(*) AS rows, MIN(nav) AS min_nav, MAX(nav) AS max_nav, MIN(date) AS earliest_date, MAX(date) AS latest_date
FROM nav_s""",
    "nav_s",
)
for _name in ("table_profile", "table_partitions", "latest_nav_date"):
    ORACLES[f"{_name}_stored"] = ORACLES[_name]
for _name in ("return_stats", "basic_volatility", "downside_risk", "upside_potential", "risk_statistics", "volatility_regime", "stale_nav", "anomaly_summary"):
    ORACLES[f"{_name}_monthly"] = ORACLES[_name]
# the same rows by another way
for _name in ("search_schemes", "schemes_by_fund_house", "schemes_by_category", "scheme_details", "fund_houses"):
    ORACLES[f"{_name}_newest"] = ORACLES[_name]
