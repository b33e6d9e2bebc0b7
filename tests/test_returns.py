import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import navlib as nl
from navlib.operators.returns import period_performance
from tests.helpers import collect_dict, day, nav_frame


def py_round(x, d):
    # display rounding of the reports: scaled value, halves away from zero
    return math.floor(abs(x) * 10**d + 0.5) / 10**d * (1 if x >= 0 else -1)


def test_daily_returns_first_row_null_and_values(spark):
    df = nav_frame(spark, {"1": [10, 11, 9.9], "2": [5]})
    got = {(r.scheme_code, r.date): r.r for r in nl.daily_returns(df).collect()}
    assert got[("1", day(0))] is None
    assert got[("1", day(1))] == pytest.approx(0.1)
    assert got[("1", day(2))] == pytest.approx(9.9 / 11 - 1)
    assert got[("2", day(0))] is None


def test_daily_returns_drops_null_nav_and_duplicate_keys(spark):
    rows = [
        ("1", "a", "H", day(0), 10.0),
        ("1", "a", "H", day(1), None),
        ("1", "a", "H", day(2), 12.0),
        ("1", "a", "H", day(2), 12.5),
    ]
    df = spark.createDataFrame(rows, "scheme_code string, scheme_name string, fund_house string, date date, nav double")
    out = nl.daily_returns(df).orderBy("date").collect()
    assert [r.nav for r in out] == [10.0, 12.5]  # null dropped, duplicate key: largest nav kept
    assert out[1].r == pytest.approx(0.25)  # the return spans the gap


def test_zero_previous_nav_gives_null_return(spark):
    df = nav_frame(spark, {"1": [10, 0, 5]})
    rs = [r.r for r in nl.daily_returns(df).orderBy("date").collect()]
    assert rs[0] is None and rs[1] == pytest.approx(-1.0) and rs[2] is None


@pytest.mark.parametrize("n", [1, 2, 30, 31, 45])
def test_period_returns_row_rule(spark, n):
    values = [100 + i for i in range(n)]
    df = nav_frame(spark, {"7": values})
    got = {r.period: r for r in nl.period_returns(df, [30]).collect()}[30]
    if n <= 30:
        start, days = values[0], n - 1
    else:
        start, days = values[-31], 30
    assert got.start_nav == start
    assert got.days_actual == days
    assert got.absolute_return == pytest.approx(values[-1] - start)
    if days == 0:
        assert got.annualized_return is None
    else:
        expected = ((values[-1] / start) ** (365.25 / days) - 1) * 100
        assert got.annualized_return == pytest.approx(py_round(expected, 2))


def test_return_stats_against_pandas(spark):
    rng = np.random.default_rng(7)
    series = {str(k): list(np.round(100 * np.cumprod(1 + rng.normal(0, 0.02, 60)), 4)) for k in range(5)}
    df = nav_frame(spark, series)
    got = collect_dict(nl.return_stats(nl.daily_returns(df)))
    for code, values in series.items():
        r = pd.Series(values).pct_change().dropna()
        g = got[code]
        assert g["daily_volatility"] == pytest.approx(round(r.std(), 6), abs=1e-6)
        assert g["annualized_volatility"] == pytest.approx(round(r.std() * 252**0.5, 4), abs=1e-4)
        assert g["max_daily_gain"] == pytest.approx(round(r.max() * 100, 2), abs=0.01)
        assert g["positive_days"] == int((r > 0).sum())
        assert g["win_rate"] == pytest.approx(round((r > 0).sum() / len(r) * 100, 1), abs=0.1)


def test_scheme_performance_needs_two_rows_and_uses_earliest_name(spark):
    rows = [
        ("1", "old", "H", day(0), 10.0),
        ("1", "new", "H", day(1), 11.0),
        ("2", "single", "H", day(0), 10.0),
    ]
    df = spark.createDataFrame(rows, "scheme_code string, scheme_name string, fund_house string, date date, nav double")
    out = nl.scheme_performance(df, [30]).collect()
    assert [r.scheme_code for r in out] == ["1"]
    assert out[0].scheme_name == "old" and out[0].data_points == 2 and out[0].current_nav == 11.0


def test_constant_nav_volatility_and_risk_adjusted(spark):
    df = nav_frame(spark, {"c": [10] * 40, "u": [10 + i for i in range(40)]})
    perf = collect_dict(period_performance(df, 365))
    assert perf["c"]["volatility"] == 0.0 and perf["c"]["risk_adjusted_return"] == 0.0
    assert perf["u"]["risk_adjusted_return"] == pytest.approx(
        py_round(perf["u"]["percentage_return"] / perf["u"]["volatility"], 2)
    )


def test_compare_schemes_ranks_and_failed_codes(spark):
    df = nav_frame(spark, {"a": [10, 11, 12, 13], "b": [10, 10.5, 10.2, 10.1], "c": [10, 9, 8, 7.5], "d": [4]})
    cmp = collect_dict(nl.compare_schemes(df, ["a", "b", "c", "d", "zz"], period=365))
    assert cmp["d"]["status"] == "failed" and cmp["zz"]["status"] == "failed"
    assert cmp["a"]["return_rank"] == 1 and cmp["c"]["return_rank"] == 3
    assert sorted(cmp[k]["risk_rank"] for k in "abc") == [1, 2, 3]
    summary = nl.compare_summary(nl.compare_schemes(df, ["a", "b", "c"])).collect()[0]
    assert summary.best_performer == "a" and summary.worst_performer == "c"
    stats = nl.compare_statistics(nl.compare_schemes(df, ["a", "b", "c"])).collect()[0]
    assert stats.highest_return == cmp["a"]["percentage_return"]


def test_compare_schemes_needs_two_codes(spark):
    df = nav_frame(spark, {"a": [1, 2]})
    with pytest.raises(ValueError):
        nl.compare_schemes(df, ["a"])


def test_top_performers_sorting_and_bad_key(spark):
    df = nav_frame(spark, {str(i): [10, 10 + i, 10 + 2 * i] for i in range(1, 8)})
    top = nl.top_performers(df, limit=3).orderBy("rank").collect()
    assert [r.scheme_code for r in top] == ["7", "6", "5"] and [r.rank for r in top] == [1, 2, 3]
    with pytest.raises(ValueError):
        nl.top_performers(df, sort_by="name")


def test_top_performer_statistics_upper_median(spark):
    # returns 0 %, 10 %, 20 %, 30 %: upper median (index n div 2) = 20 %
    df = nav_frame(spark, {str(i): [100, 100 + 10 * i] for i in range(4)})
    s = nl.top_performer_statistics(period_performance(df, 365)).collect()[0]
    assert s.total_schemes_analyzed == 4 and s.median_return == 20.0 and s.average_return == 15.0


def test_global_row_number_matches_sorted_order(spark):
    from navlib.functions.ranking import global_row_number

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": [f"{i:05d}" for i in range(2000)], "v": rng.integers(0, 5, 2000).astype(float)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = global_row_number(df, [F.col("v").desc(), F.col("k")], "rn", num_partitions=6).toPandas()
    expected = pdf.sort_values(["v", "k"], ascending=[False, True]).reset_index(drop=True)
    expected["rn"] = range(1, len(expected) + 1)
    merged = got.merge(expected, on="k", suffixes=("", "_e"))
    assert len(merged) == 2000 and (merged.rn == merged.rn_e).all()


def test_global_ranks_match_pandas(spark):
    from navlib.functions.ranking import global_ranks

    rng = np.random.default_rng(5)
    n = 500
    pdf = pd.DataFrame(
        {
            "k": [f"{i:04d}" for i in range(n)],
            "a": np.where(rng.random(n) < 0.1, np.nan, rng.integers(-3, 4, n).astype(float)),
            "b": rng.normal(size=n).round(1),
        }
    )
    df = spark.createDataFrame(pdf).replace(float("nan"), None).repartition(5)
    got = global_ranks(df, "k", {"ra": ("a", True), "rb": ("b", False)}, num_partitions=4).toPandas().set_index("k")
    ea = pdf.assign(n=pdf.a.isna()).sort_values(["n", "a", "k"], ascending=[True, False, True]).k.tolist()
    eb = pdf.sort_values(["b", "k"]).k.tolist()
    assert [got.loc[k, "ra"] for k in ea] == list(range(1, n + 1))
    assert [got.loc[k, "rb"] for k in eb] == list(range(1, n + 1))


@pytest.mark.parametrize("advisory", ["2kb", "32kb"])
def test_global_row_number_with_adaptive_coalescing(spark, advisory):
    from navlib.functions.ranking import global_row_number

    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"k": [f"{i:05d}" for i in range(3000)], "v": rng.integers(0, 7, 3000).astype(float)})
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    try:
        got = global_row_number(spark.createDataFrame(pdf).repartition(6), [F.col("v"), F.col("k")], "rn").toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    expected = pdf.sort_values(["v", "k"]).reset_index(drop=True)
    expected["rn"] = range(1, len(expected) + 1)
    merged = got.merge(expected, on="k", suffixes=("", "_e"))
    assert len(merged) == 3000 and (merged.rn == merged.rn_e).all()


@pytest.mark.parametrize("kind", ["even", "ties", "wild", "powers", "infinite", "one", "negative"])
def test_value_at_every_rank(spark, kind, monkeypatch):
    import random

    from navlib.functions import selection

    monkeypatch.setattr(selection, "BINS", 8)
    rng = random.Random(2)
    values = {
        "even": [rng.uniform(-5, 5) for _ in range(40)],
        "ties": [float(rng.randint(0, 3)) for _ in range(40)],
        "wild": [rng.gauss(0, 1) for _ in range(30)] + [1e308, -1e308, 1e-300, 5e-324, 0.0],
        "powers": [2.0**k for k in range(-30, 30)],
        "infinite": [float("inf")] * 3 + [float("-inf")] * 4 + [rng.gauss(0, 1) for _ in range(20)],
        "one": [7.5],
        "negative": [-(10.0**k) for k in range(20)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").checkpoint()
    order = sorted(values)
    for k in range(1, len(order) + 1, 3):
        assert selection.value_at(df, "x", lambda n: k) == order[k - 1]  # noqa: B023
    assert selection.value_at(df, "x", lambda n: n // 2 + 1) == order[len(order) // 2]
    assert selection.value_at(df, "x", lambda n: n + 1) is None and selection.value_at(df.limit(0), "x", lambda n: 1) is None


def test_median_needs_no_sort(spark, sf_small):
    from navlib.operators.returns import period_performance
    from navlib.plans.inspect import plan_text
    from navlib.sources import fixtures as fx

    text = plan_text(nl.top_performer_statistics(period_performance(fx.nav_s(spark, sf_small), 365)))
    assert "Sort" not in text and "rangepartitioning" not in text and "Window" not in text
