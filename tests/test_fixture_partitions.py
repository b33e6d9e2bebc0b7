import datetime as dt

import pytest
from pyspark.sql import functions as F

import navlib as nl
from navlib.operators.master import latest_nav
from navlib.plans.inspect import shuffle_count
from navlib.sources import fixtures as fx


@pytest.fixture
def tables(spark, tmp_path):
    """40 parts and suppliers with a row on each of 40 days, twice on the first; one row without keys."""
    days = [dt.datetime(1998, 1, 1) + dt.timedelta(days=i) for i in [0, *range(40)]]
    rows = [(k, k, float(100 + (k * 31 + i * 17) % 23), d) for k in range(40) for i, d in enumerate(days)]
    rows.append((None, None, 5.0, days[0]))
    kinds = {
        "lineitem": (rows, "l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_shipdate timestamp"),
        "part": ([(k, f"part {k}", "type", "brand") for k in range(40)], "p_partkey bigint, p_name string, p_type string, p_brand string"),
        "supplier": ([(k, f"supplier {k}", k % 2) for k in range(40)], "s_suppkey bigint, s_name string, s_nationkey bigint"),
        "nation": ([(0, "north"), (1, "south")], "n_nationkey bigint, n_name string"),
    }
    for name, (found, schema) in kinds.items():
        spark.createDataFrame(found, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_series_are_dealt_by_scheme_in_partitions_of_fixed_size(spark, tables, monkeypatch):
    """More rows, more partitions, none much larger; each scheme in one of them; a report shuffles no row again."""
    for rows, parts in ((1 << 18, 1), (100, 17)):
        monkeypatch.setattr(fx, "SCHEME_ROWS", rows)
        for nav in (fx.nav_p(spark, tables), fx.nav_s(spark, tables, by_scheme=True)):
            assert nav.rdd.getNumPartitions() == parts
            place = nav.select("scheme_code", F.spark_partition_id().alias("part")).groupBy("scheme_code")
            place = place.agg(F.count_distinct("part").alias("n"), F.count("*").alias("rows"))
            assert [(r.n, r.rows) for r in place.collect()] == [(1, 40)] * 40
            # by scheme and day for the daily mean, by scheme, and the names: none behind them
            for report in (nl.basic_volatility(nav), nl.rolling_volatility(nav, 5), latest_nav(nav)):
                assert shuffle_count(report) == 3


def test_series_by_scheme_have_the_same_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(fx, "SCHEME_ROWS", 100)
    plain, dealt = (sorted(map(tuple, fx.nav_s(spark, tables, by_scheme=b).collect())) for b in (False, True))
    assert plain == dealt and len(plain) == 1600
    parts = {(r.scheme_code, r.date): r for r in fx.nav_p(spark, tables).collect()}
    assert len(parts) == 1600
    first = parts["3", dt.date(1998, 1, 1)]
    assert (first.scheme_name, first.fund_house) == ("part 3 type", "brand")
    assert first.nav == pytest.approx((100 + 93 % 23 + 100 + 110 % 23) / 2 / 10)
