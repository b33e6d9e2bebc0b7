"""Plan shape: one shuffle per per-scheme report, pruning reaches the scan, no Python workers."""

import pytest

import navlib as nl
from navlib.operators.master import with_partition_columns
from navlib.plans.inspect import plan_text, python_nodes, shuffle_count
from navlib.sources import fixtures as fx
from navlib.sources.store import scratch_path


@pytest.fixture(scope="module")
def stored(spark, sf_small):
    path = scratch_path(spark, "nav")
    nl.write_table(with_partition_columns(fx.nav_s(spark, sf_small)), path, ["year", "month"], "overwrite")
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "op",
    [
        lambda n: nl.scheme_performance(n),
        lambda n: nl.period_returns(n),
        lambda n: nl.basic_volatility(n),
        lambda n: nl.value_at_risk(n),
        lambda n: nl.rolling_volatility(n),
        lambda n: nl.stale_nav(n),
        lambda n: nl.scheme_master(n),
    ],
)
def test_per_scheme_reports_shuffle_once(spark, stored, op):
    # copies and older versions are collapsed first (map-side aggregate + shuffle on the key), then one per-scheme shuffle
    assert shuffle_count(op(stored)) <= 2


def test_date_lookup_prunes_partitions_and_columns(stored):
    text = plan_text(nl.nav_between(stored, "1998-01-01", "1998-03-31"))
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,1998-01-01)" in text
    scan = plan_text(nl.latest_nav_date(stored))
    assert "ReadSchema: struct<date:date>" in scan


def test_no_python_evaluation(stored, spark, sf_small):
    frames = [
        nl.scheme_performance(stored),
        nl.top_performers(stored),
        nl.period_returns(stored),
        nl.basic_volatility(stored),
        nl.anomaly_summary(stored),
        nl.similar_names(fx.master_p(spark, sf_small)),
        nl.duplicate_summary(fx.master_p(spark, sf_small)),
        nl.dq_overall(fx.nav_ticks(spark, sf_small)),
        nl.parse_nav_text(fx.feed_lines(spark, sf_small)),
        nl.nav_as_of(fx.nav_ticks(spark, sf_small), load_id=3),
    ]
    assert all(python_nodes(f) == 0 for f in frames)


def test_similar_names_has_no_nested_loop(spark, sf_small):
    text = plan_text(nl.similar_names(fx.master_p(spark, sf_small)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_correlation_plan_does_not_grow_with_the_schemes(spark, sf_small):
    import time

    nav = fx.nav_p(spark, sf_small)
    codes = [r[0] for r in nav.select("scheme_code").distinct().limit(200).collect()]
    sizes, seconds = [], []
    for k in (20, 200):
        t = time.time()
        df = nl.correlation_matrix(nav, codes[:k], min_overlap=2)
        seconds.append(time.time() - t)
        sizes.append(len(df._jdf.queryExecution().analyzed().toString().splitlines()))
    assert sizes[0] == sizes[1]
    assert seconds[1] < 5 * seconds[0] + 10
