
import numpy as np
import pyspark.sql.functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import navlib as nl
from navlib.sources import fixtures as fx
from tests.helpers import nav_frame
from tests.test_quality import MASTER, brute_similar_pairs


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.text(alphabet="ab- A", min_size=0, max_size=6), st.sampled_from(["H1", "H2"])),
        min_size=1,
        max_size=40,
    )
)
def test_similar_names_property(spark, names):
    rows = [(str(i), n, h) for i, (n, h) in enumerate(names)]
    df = spark.createDataFrame(rows, MASTER)
    got = nl.similar_names(df).agg(F.coalesce(F.sum("pair_count"), F.lit(0))).collect()[0][0]
    assert got == brute_similar_pairs(rows)


def test_correlation_matrix_is_symmetric_with_unit_diagonal(spark, sf_small):
    rng = np.random.default_rng(12)
    series = {c: list(100 * np.cumprod(1 + rng.normal(0, 0.01, 160))) for c in "abcd"}
    out = nl.correlation_matrix(nav_frame(spark, series), list("abcd")).collect()
    m = {(r.scheme1, r.scheme2): r.correlation for r in out}
    assert len(m) == 16
    for a in "abcd":
        assert m[(a, a)] == 1.0
        for b in "abcd":
            assert m[(a, b)] == m[(b, a)] and -1.0 <= m[(a, b)] <= 1.0


def test_results_do_not_depend_on_partitioning(spark, sf_small):
    nav = fx.nav_s(spark, sf_small)
    for op in (nl.scheme_performance, nl.basic_volatility, nl.anomaly_summary, nl.value_at_risk):
        assert _rows(op(nav)) == _rows(op(nav.repartition(13))) == _rows(op(nav.coalesce(1)))


def test_as_of_newest_load_equals_dedup(spark, sf_small):
    ticks = fx.nav_ticks(spark, sf_small).drop("tie")
    newest = nl.nav_as_of(ticks)
    assert newest.count() == ticks.select("scheme_code", "date").distinct().count()
    assert newest.count() == nl.nav_as_of(ticks, load_id=10**9).count()


def test_hot_scheme_copies_are_collapsed(spark):
    # one scheme holds a third of all rows as copies of its own days
    base = nav_frame(spark, {str(i): [100 + i + d for d in range(40)] for i in range(20)})
    hot = base.where(F.col("scheme_code") == "0")
    copies = hot.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(19)))).drop("_copy")
    raw = base.unionByName(copies)
    assert copies.count() * 2 >= raw.count() * 0.66
    clean = nl.deduplicate_nav(raw.withColumn("fund_house", F.lit("H")))
    assert clean.count() == base.count()
    assert _rows(nl.return_stats(nl.daily_returns(clean))) == _rows(nl.return_stats(nl.daily_returns(base)))
    # daily_returns alone also keeps one row per key
    assert nl.daily_returns(raw).count() == base.count()


def test_copies_change_nothing(spark, sf_small):
    nav = fx.nav_s(spark, sf_small)
    twice = nav.unionByName(nav)
    for op in (nl.scheme_performance, nl.value_at_risk, nl.anomaly_summary, nl.rolling_volatility):
        if op is nl.anomaly_summary:
            continue  # its row gate counts stored rows
        assert _rows(op(nav)) == _rows(op(twice))
