import navlib as nl
from navlib.plans import reports
from navlib.sources import fixtures as fx


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_reports_equal_the_single_operators(spark, sf_small):
    nav = fx.nav_s(spark, sf_small)
    vol = reports.volatility_report(nav, window=20)
    assert _same(vol["basic_volatility"], nl.basic_volatility(nav))
    assert _same(vol["rolling_volatility"], nl.rolling_volatility(nav, 20))
    assert _same(vol["value_at_risk"], nl.value_at_risk(nav))
    an = reports.anomaly_report(nav)
    assert _same(an["summary_statistics"], nl.anomaly_summary(nav))
    assert _same(an["nav_jumps"], nl.nav_jumps(nav))
    cmp = reports.comparison_report(nav)
    assert _same(cmp["summary"], nl.compare_summary(nl.compare_schemes(nav)))
    top = reports.top_performers_report(nav, limit=5)
    assert _same(top["top_performers"], nl.top_performers(nav, limit=5))


def test_correlation_report_matches_operators(spark):
    import numpy as np

    from tests.helpers import nav_frame

    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.01, 200)
    series = {
        "a": list(100 * np.cumprod(1 + base)),
        "b": list(100 * np.cumprod(1 + base + rng.normal(0, 0.001, 200))),
        "c": list(100 * np.cumprod(1 + rng.normal(0, 0.01, 200))),
    }
    nav = nav_frame(spark, series)
    rep = reports.correlation_report(nav, ["a", "b", "c"])
    assert _same(rep["correlation_matrix"], nl.correlation_matrix(nav, ["a", "b", "c"]))
    assert _same(rep["notable_pairs"], nl.notable_pairs(nav, ["a", "b", "c"]))
    assert _same(rep["correlation_statistics"], nl.correlation_statistics(nav, ["a", "b", "c"]))
    assert _same(rep["investment_insights"], nl.diversification_insights(nav, ["a", "b", "c"]))


def test_quality_duplicate_and_performance_reports(spark, sf_small):
    ticks = fx.nav_ticks(spark, sf_small)
    q = reports.quality_report(ticks)
    assert set(q) == {
        "null_checks", "invalid_nav_values", "duplicate_records", "date_consistency",
        "scheme_code_validation", "overall_quality",
    }
    assert _same(q["overall_quality"], nl.dq_overall(ticks))
    master = fx.master_p(spark, sf_small)
    d = reports.duplicate_report(master)
    assert _same(d["summary"], nl.duplicate_summary(master))
    perf = reports.performance_report(fx.nav_s(spark, sf_small), [30])
    assert perf["scheme_performance"].select("period").distinct().collect()[0].period == 30
