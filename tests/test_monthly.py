import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import navlib as nl
from navlib.operators import monthly as M
from navlib.operators.master import with_partition_columns
from navlib.sources import fixtures as fx
from navlib.sources.store import scratch_path
from tests.helpers import NAV_TYPE, day

REPORTS = ("return_stats", "basic_volatility", "downside_risk", "upside_potential", "risk_statistics", "volatility_regime")


def _odd_nav(spark):
    """Series with gaps of months, zero NAVs, missing names, one-row months, unchanged runs over month borders."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(14):
        days = np.cumsum(rng.choice([1, 1, 1, 2, 5, 40], rng.integers(1, 120)))
        value = 100.0
        for i, d in enumerate(days.tolist()):
            value = value if rng.random() < 0.3 else round(value * (1 + rng.normal(0, 0.02)), 2)
            nav = 0.0 if k == 3 and i % 17 == 5 else value
            name = None if k in (4, 5) and i % 3 == 0 or k == 6 else f"n{k} {'old' if i < 9 else 'new'}"
            rows.append((f"c{k}", name, "H", day(d), nav))
    rows += [("flat", "flat", "H", day(i), 7.0) for i in range(100)]
    rows += [("short", "short", "H", day(3), 1.0), (None, "x", "H", day(3), 1.0), ("c1", "c1", "H", None, 1.0), ("c1", "n", "H", day(9000), None)]
    rows += rows[:5]
    return spark.createDataFrame(rows, NAV_TYPE)


def _same(a, b):
    rows = lambda df: sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)
    x, y = rows(a), rows(b)
    assert len(x) == len(y)
    for p, q in zip(x, y, strict=True):
        for (name, u), (_, v) in zip(p, q, strict=True):
            assert u == v or (isinstance(u, float) and u == pytest.approx(v, rel=1e-9, abs=1e-9)), (p, q, name)


def _full(name, nav):
    return nl.return_stats(nl.daily_returns(nav)) if name == "return_stats" else getattr(nl, name)(nav)


def test_reports_equal_those_over_all_rows(spark):
    nav = _odd_nav(spark)
    states = M.month_states(nav).checkpoint()
    merged = M.merged_states(states).checkpoint()
    for name in REPORTS:
        _same(getattr(M, name)(merged), _full(name, nav))
    for run in (1, 3, 5):
        _same(M.stale_nav(states, run), nl.stale_nav(nav, run))
    assert nl.basic_volatility(nav).count() > 5 and nl.stale_nav(nav, 3).count() > 3
    for std, run in ((3.0, 5), (0.5, 2), (50.0, 9)):
        _same(M.anomaly_summary(states, nav, std, run), nl.anomaly_summary(nav, std, min_run=run))
    row = M.anomaly_summary(states, nav, 1.0, 2).first()
    assert row.extreme_returns and row.nav_jumps and row.data_quality_issues and row.suspicious_patterns


def test_only_months_with_extremes_are_read(spark, sf_small):
    """A table whose other months are garbage gives the same summary: the states answer for them."""
    nav = with_partition_columns(fx.nav_s(spark, sf_small)).checkpoint()
    states = M.month_states(nav).checkpoint()
    r = nl.analysed_rows(nav).toPandas().r
    far = 0.95 * float((r - r.mean()).abs().max() / r.std())  # only the farthest returns are extreme
    low, high = r.mean() - far * r.std(), r.mean() + far * r.std()
    hot = states.where((F.col("named.low") < low) | (F.col("named.high") > high)).select("year", "month").distinct().checkpoint()
    assert hot.count() < 0.2 * states.select("year", "month").distinct().count()
    garbage = nav.join(hot, ["year", "month"], "left_anti").withColumn("nav", F.lit(-1.0))
    broken = garbage.unionByName(nav.join(hot, ["year", "month"], "left_semi").select(garbage.columns))
    assert nl.anomaly_summary(nav, far).first().extreme_returns > 0
    _same(M.anomaly_summary(states, broken, far), nl.anomaly_summary(nav, far))
    _same(M.anomaly_summary(states, nav), nl.anomaly_summary(nav))


def test_stale_runs_for_every_cut(spark, sf_small):
    """Segments of any place: each row's month is cut at another day, runs stay the same."""
    nav = fx.nav_stale(spark, sf_small).checkpoint()
    want = sorted(map(tuple, nl.stale_nav(nav).collect()))
    assert want
    for shift in (0, 7, 13, 22, 29):
        # the calendar moves, so other rows stand at month borders
        moved = nav.withColumn("date", F.date_add("date", shift))
        assert sorted(map(tuple, M.stale_nav(M.month_states(moved)).collect())) == want


def test_new_month_reads_one_month(spark, sf_small):
    from navlib.plans.inspect import plan_text

    path, states = scratch_path(spark, "nav"), scratch_path(spark, "states")
    nav = fx.nav_s(spark, sf_small)
    nl.write_table(with_partition_columns(nav), path, ["year", "month"], "overwrite")
    stored = nl.read_table(spark, path)
    months = sorted((r.year, r.month) for r in stored.select("year", "month").distinct().collect())
    M.refresh_month_states(spark, states, stored, months[:-1])
    before = set(spark.read.parquet(states).inputFiles())
    one = M.month_states(stored.where((F.col("year") * 100 + F.col("month")).isin([months[-1][0] * 100 + months[-1][1]])))
    assert re.search(r"PartitionFilters: \[.*year#", plan_text(one))
    table = M.refresh_month_states(spark, states, stored, months[-1:])
    assert before < set(table.inputFiles())
    merged = M.merged_states(table)
    for name in ("return_stats", "risk_statistics"):
        _same(getattr(M, name)(merged), _full(name, nav))
    # a corrected month replaces its states
    y, m = months[5]
    fixed = stored.withColumn("nav", F.when((F.col("year") == y) & (F.col("month") == m), F.col("nav") * 3).otherwise(F.col("nav")))
    table = M.refresh_month_states(spark, states, fixed, [(y, m)])
    _same(M.risk_statistics(M.merged_states(table)), nl.risk_statistics(fixed))


def test_empty(spark):
    nav = spark.createDataFrame([], NAV_TYPE)
    merged = M.merged_states(M.month_states(nav))
    assert all(getattr(M, name)(merged).count() == 0 for name in REPORTS)
    assert M.stale_nav(M.month_states(nav)).count() == 0
    assert M.anomaly_summary(M.month_states(nav), nav).count() == 0
