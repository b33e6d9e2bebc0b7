"""Report figures against textbook formulas and answers worked out by hand."""

import math
import statistics as st

import pytest

import navlib as nl
from tests.helpers import day, nav_frame


def series(returns, start=100.0):
    out = [start]
    for r in returns:
        out.append(out[-1] * (1 + r))
    return out


def test_performance_by_hand(spark):
    # 100 → 110 → 99 → 108.9: +10 %, -10 %, +10 %
    got = nl.scheme_performance(nav_frame(spark, {"a": [100.0, 110.0, 99.0, 108.9], "b": [5.0]}), [1, 2, 30]).collect()
    rows = {r.period: r for r in got}
    assert {r.scheme_code for r in got} == {"a"} and set(rows) == {1, 2, 30}
    assert [rows[p].percentage_return for p in (1, 2, 30)] == [10.0, -1.0, 8.9]
    assert [rows[p].start_date for p in (1, 2, 30)] == [day(2), day(1), day(0)]
    assert [rows[p].days_actual for p in (1, 2, 30)] == [1, 2, 3]
    assert rows[30].annualized_return == pytest.approx((1.089 ** (365.25 / 3) - 1) * 100, rel=1e-6)
    assert rows[30].win_rate == 66.7 and rows[30].max_daily_gain == 10.0 and rows[30].max_daily_loss == -10.0
    assert rows[30].annualized_volatility == pytest.approx(math.sqrt(252) * st.stdev([0.1, -0.1, 0.1]), abs=1e-4)


def test_large_growth_has_nine_digits(spark):
    got = nl.period_returns(nav_frame(spark, {"a": [100.0, 120.0]}), [30]).collect()[0].annualized_return
    exact = (1.2 ** 365.25 - 1) * 100
    assert got == pytest.approx(exact, rel=1e-8) and float(f"{got:.8e}") == pytest.approx(got, rel=1e-15)


def test_volatility_by_formula(spark):
    returns = [0.01 * ((7 * i) % 11 - 5) for i in range(60)]
    nav = nav_frame(spark, {"a": series(returns), "short": series(returns[:20])})
    sd = st.stdev(returns)
    basic = nl.basic_volatility(nav).collect()
    assert [r.scheme_code for r in basic] == ["a"]
    assert basic[0].annualized_volatility == pytest.approx(sd * math.sqrt(252), abs=1e-4)
    assert basic[0].weekly_volatility == pytest.approx(sd * math.sqrt(5), abs=1e-6)
    var = nl.value_at_risk(nav).collect()[0]
    low = sorted(returns)
    at = 0.05 * (len(low) - 1)
    q05 = low[int(at)] + (at - int(at)) * (low[int(at) + 1] - low[int(at)])  # linear between order statistics
    assert var.var_95_percent == pytest.approx(100 * q05, abs=0.01)
    assert var.expected_shortfall_95 == pytest.approx(100 * st.mean(r for r in returns if r <= q05), abs=0.01)


@pytest.mark.parametrize("bad", [1e-6, 1e-4, 1e8])
def test_rolling_volatility_with_a_bad_price(spark, bad):
    nav = series([0.01 * ((5 * i) % 7 - 3) for i in range(400)])
    nav[150] = bad
    returns = [b / a - 1 for a, b in zip(nav, nav[1:])]
    w = 20
    exact = [math.sqrt(252) * st.stdev(returns[i - w : i]) for i in range(w, len(returns) + 1)]
    got = nl.rolling_volatility(nav_frame(spark, {"a": nav}), w).collect()[0]
    assert got.current_rolling_vol == pytest.approx(exact[-1], abs=1e-4)
    assert got.min_rolling_vol == pytest.approx(min(exact), abs=1e-4)
    assert got.max_rolling_vol == pytest.approx(max(exact), rel=1e-6)


def test_extremes_pooled_and_by_scheme(spark):
    calm, wild = [0.001 * (-1) ** i for i in range(99)], [0.1 * (-1) ** i for i in range(99)]
    calm[50] = 0.02  # far out for its own scheme, nothing for the pool
    nav = nav_frame(spark, {"calm": series(calm), "wild": series(wild)})
    assert nl.extreme_returns(nav).count() == 0
    own = nl.extreme_returns(nav, scope="scheme").collect()
    assert [(r.scheme_code, r.date, r.daily_return) for r in own] == [("calm", day(51), 2.0)]
    with pytest.raises(ValueError):
        nl.extreme_returns(nav, scope="other")


def test_correlation_by_hand(spark):
    up = [0.01, -0.02, 0.03, 0.01, -0.01, 0.02] * 5
    half, down = [r / 2 for r in up], [-r for r in up]
    odd = [0.01 * ((3 * i) % 5 - 2) for i in range(30)]
    nav = nav_frame(spark, {"up": series(up), "half": series(half), "down": series(down), "odd": series(odd)})
    got = {(r.scheme1, r.scheme2): r.correlation for r in nl.correlation_matrix(nav, ["up", "half", "down", "odd"], min_overlap=10).collect()}
    assert len(got) == 16
    assert got["up", "half"] == 1.0 and got["up", "down"] == -1.0 and got["odd", "odd"] == 1.0
    mx, my = st.mean(up), st.mean(odd)
    r = sum((x - mx) * (y - my) for x, y in zip(up, odd)) / math.sqrt(sum((x - mx) ** 2 for x in up) * sum((y - my) ** 2 for y in odd))
    assert got["up", "odd"] == got["odd", "up"] == pytest.approx(r, abs=1e-4)


def test_identical_schemes_are_not_diversified(spark):
    up = [0.01, -0.02, 0.03, 0.01, -0.01] * 6
    codes = [f"c{i}" for i in range(4)]
    nav = nav_frame(spark, {c: series(up) for c in codes})
    stats = nl.correlation_statistics(nav, codes, min_overlap=10).collect()[0]
    assert stats.average_correlation == 1.0 and stats.diversification_score == 0.0
    insight = nl.diversification_insights(nav, codes, min_overlap=10).collect()[0]
    assert (insight.portfolio_diversification, insight.concentration_risk) == ("Poor", "High")


def test_correlation_needs_a_list_or_top_k(spark):
    with pytest.raises(ValueError):
        nl.correlation_matrix(nav_frame(spark, {"a": [1.0, 2.0]}))


def test_compare_reports_single_row_schemes_as_failed(spark):
    got = {r.scheme_code: (r.status, r.return_rank) for r in nl.compare_schemes(nav_frame(spark, {"a": [1.0, 2.0], "b": [1.0, 3.0], "c": [1.0]})).collect()}
    assert got == {"a": ("ok", 2), "b": ("ok", 1), "c": ("failed", None)}


def test_lookups_know_nav_only_schemes(spark):
    nav = nav_frame(spark, {"1": [10.0, 11.0], "2": [20.0]})
    master = spark.createDataFrame([("1", "Master One", "House")], "scheme_code string, scheme_name string, fund_house string")
    rows = {r.scheme_code: tuple(r)[1:] for r in nl.search_schemes(master, "o|name", nav=nav).collect()}
    assert rows == {"1": ("Master One", "House", 11.0, day(1)), "2": ("name 2", "H", 20.0, day(0))}
    assert [r[0] for r in nl.fund_houses(master, nav).collect()] == ["H", "House"]
    assert nl.schemes_by_fund_house(master, "house").collect()[0].nav is None
    assert [r.scheme_code for r in nl.schemes_by_category(master, "NAME", nav).collect()] == ["2"]


def test_compounded_views_reach_every_branch(spark):
    from navlib.plans.registry import QUERIES

    sf = "/root/testdata/sf0.01"
    regimes = {(r.regime, r.risk_level) for r in QUERIES["volatility_regime_compounded"](spark, sf).collect()}
    assert {r for r, _ in regimes} == {"Low Volatility", "Moderate Volatility", "High Volatility", "Very High Volatility"}
    assert {level for _, level in regimes} == {"Low", "Medium", "High"}
    assert {r.kind for r in QUERIES["notable_pairs_compounded"](spark, sf).collect()} == {"high", "low"}
