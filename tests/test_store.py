import pyspark.sql.functions as F
import pytest

import navlib as nl
from navlib.schema import NAV_SCHEMA
from navlib.sources import fixtures as fx
from navlib.sources.store import scratch_path
from tests.helpers import day


def test_read_missing_path_gives_typed_empty(spark):
    df = nl.read_table(spark, scratch_path(spark, "nothing"), NAV_SCHEMA)
    assert df.count() == 0 and df.schema == NAV_SCHEMA
    assert nl.read_table(spark, scratch_path(spark, "nothing")) is None


def test_parse_feed_drops_bad_lines(spark):
    lines = [
        "Scheme Code;ISIN Div Payout;ISIN Reinv;Scheme Name;Net Asset Value;Date",
        "",
        "Some Fund House",
        "100;INF1;INF2; Alpha Fund ;12.3456;15-Jun-2024",
        "101;INF1;INF2;Beta;N.A.;15-Jun-2024",
        "102;INF1;INF2;Gamma;-;15-Jun-2024",
        "103;INF1;INF2;Delta;abc;15-Jun-2024",
        "104;INF1;INF2;Eps;1.0;31-Foo-2024",
        "105;INF1",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    out = nl.parse_nav_text(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.scheme_code, r.scheme_name, r.nav, r.date, r.fund_house, r.year, r.month) == (
        "100", "Alpha Fund", 12.3456, __import__("datetime").date(2024, 6, 15), "To be mapped", 2024, 6
    )
    houses = spark.createDataFrame([("100", "Alpha AMC")], "scheme_code string, fund_house string")
    assert nl.parse_nav_text(df, houses).collect()[0].fund_house == "Alpha AMC"


def test_ingest_twice_is_once_and_as_of(spark, sf_small):
    path = scratch_path(spark, "nav")
    master = scratch_path(spark, "master")
    batch = nl.parse_nav_text(fx.feed_lines(spark, sf_small))
    first = nl.ingest_nav(batch, path, master, load_id=1).count()
    second = nl.ingest_nav(batch, path, master, load_id=2).count()
    stored = nl.read_table(spark, path)
    assert first > 0 and second == 0 and stored.count() == first
    assert stored.select("scheme_code", "date").distinct().count() == first
    # a later feed with one new day adds only the new key
    extra = spark.createDataFrame(
        [("1", "Supplier#000000001", 1.0, day(9000), "To be mapped", 2044, 8)],
        "scheme_code string, scheme_name string, nav double, date date, fund_house string, year int, month int",
    )
    assert nl.ingest_nav(batch.unionByName(extra), path, master, load_id=3).count() == 1
    stored = nl.read_table(spark, path)
    assert nl.nav_as_of(stored, load_id=1).count() == first
    assert nl.nav_as_of(stored).count() == first + 1
    m = nl.read_table(spark, master)
    assert m.count() == m.select("scheme_code").distinct().count()


def _nav(spark, *rows):
    kind = "scheme_code string, scheme_name string, nav double, date date, fund_house string"
    return spark.createDataFrame([(c, n, v, day(d), "H") for c, n, v, d in rows], kind)


def test_corrected_nav_becomes_a_new_version(spark):
    path = scratch_path(spark, "nav")
    nl.ingest_nav(_nav(spark, ("a", "A", 10.0, 0), ("a", "A", 11.0, 1)), path, load_id=1)
    again = nl.ingest_nav(_nav(spark, ("a", "A", 11.5, 0), ("a", "A", 11.0, 1)), path, load_id=2)
    assert [(r.nav, r.date) for r in again.collect()] == [(11.5, day(0))]
    # corrected downwards too: the newest load wins, not the largest NAV
    nl.ingest_nav(_nav(spark, ("a", "A", 9.0, 0)), path, load_id=3)
    stored = nl.read_table(spark, path)
    assert {r.date: r.nav for r in nl.nav_as_of(stored).collect()} == {day(0): 9.0, day(1): 11.0}
    assert {r.date: r.nav for r in nl.nav_as_of(stored, load_id=2).collect()} == {day(0): 11.5, day(1): 11.0}
    assert sorted(r.nav for r in nl.daily_returns(stored).collect()) == [9.0, 11.0]


def test_master_never_goes_back_and_survives_a_retry(spark):
    path, master = scratch_path(spark, "nav"), scratch_path(spark, "master")
    names = lambda: {r.scheme_code: r.scheme_name for r in nl.read_table(spark, master).collect()}
    nl.ingest_nav(_nav(spark, ("a", "NEW", 1.0, 900)), path, master, load_id=1)
    nl.ingest_nav(_nav(spark, ("a", "OLD", 1.0, 5), ("b", "B", 1.0, 5)), path, master, load_id=2)
    assert names() == {"a": "NEW", "b": "B"}
    late = _nav(spark, ("c", "C", 1.0, 7))
    nl.ingest_nav(late, path, None, load_id=3)  # as if it had died before the refresh
    assert nl.ingest_nav(late, path, master, load_id=4).count() == 0
    assert names() == {"a": "NEW", "b": "B", "c": "C"}
    rebuilt = nl.refresh_master(spark, master, _nav(spark, ("z", "Z", 1.0, 1)), rebuild=True)
    assert rebuilt.columns == ["scheme_code", "scheme_name", "fund_house"] and names() == {"z": "Z"}


def test_compact_one_or_all(spark, sf_small):
    from navlib.operators.master import with_partition_columns

    nav = scratch_path(spark, "nav")
    for part in range(3):  # three appends: many small files
        rows = with_partition_columns(fx.nav_s(spark, sf_small)).where(F.col("scheme_code").cast("int") % 3 == part)
        nl.write_table(rows, nav, ["year", "month"], "append")
    paths = {"nav": nav, "gone": scratch_path(spark, "gone")}
    current, status = nl.compact_tables(spark, paths)
    assert {r.table: r.status for r in status.collect()} == {"nav": "success", "gone": "skipped"}
    assert current["gone"] == paths["gone"] and current["nav"] != nav
    before, after = spark.read.parquet(nav), spark.read.parquet(current["nav"])
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.select(before.columns).collect()))
    assert len(after.inputFiles()) < len(before.inputFiles())
    order = after.select("date", "scheme_code", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).collect()
    by_file = {}
    for r in sorted(order, key=lambda r: r.i):
        by_file.setdefault(r.f, []).append((r.date, r.scheme_code))
    assert all(v == sorted(v) for v in by_file.values())
    try:
        nl.compact_tables(spark, paths, "unknown")
    except ValueError:
        pass
    else:
        raise AssertionError("unknown table accepted")
    assert [r.column_name for r in nl.table_schema(after).collect()] == after.columns


def test_compact_keeps_rows_and_profile(spark, sf_small):
    from navlib.operators.master import with_partition_columns

    src = scratch_path(spark, "nav")
    nl.write_table(with_partition_columns(fx.nav_s(spark, sf_small)), src, ["year", "month"], "overwrite")
    out = nl.compact_table(spark, src, scratch_path(spark, "nav_c"))
    assert out.count() == spark.read.parquet(src).count()
    prof = nl.table_profile(out).collect()[0]
    parts = nl.table_partitions(out)
    assert prof.partition_count == parts.count()
    assert parts.agg(F.sum("rows")).collect()[0][0] == prof.row_count
    assert parts.collect()[0].partition.startswith("year=")


def test_write_modes(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1,)], "a int")
    nl.write_table(df, path, mode="append")
    nl.write_table(df, path, mode="ignore")
    assert nl.read_table(spark, path).count() == 1
    try:
        nl.write_table(df, path, mode="bogus")
    except ValueError:
        pass
    else:
        raise AssertionError("bad mode accepted")


def test_redelivered_months_are_not_read(spark, monkeypatch):
    from navlib.sources import store

    path = scratch_path(spark, "nav")
    feed = _nav(spark, *[(c, c.upper(), 10.0 + d, d) for c in "abc" for d in range(0, 120, 7)])
    first = nl.ingest_nav(feed, path, load_id=1).count()
    with monkeypatch.context() as m:
        m.setattr(store, "nav_as_of", lambda *a, **k: (_ for _ in ()).throw(AssertionError("stored rows were read")))
        # other row order, other split, copies
        assert nl.ingest_nav(feed.unionByName(feed).repartition(5), path, load_id=2).count() == 0
        assert nl.ingest_nav(feed.where(F.month("date") == 2), path, load_id=3).count() == 0
    assert nl.read_table(spark, path).count() == first
    # one corrected row: its month is compared, the others aren't read
    fixed = feed.withColumn("nav", F.when((F.col("scheme_code") == "a") & (F.col("date") == day(35)), 99.0).otherwise(F.col("nav")))
    read = []
    as_of = store.nav_as_of
    monkeypatch.setattr(store, "nav_as_of", lambda df, *a, **k: read.append(df.select("year", "month").distinct().count()) or as_of(df, *a, **k))
    assert [(r.nav, r.date) for r in nl.ingest_nav(fixed, path, load_id=4).collect()] == [(99.0, day(35))]
    assert read == [1]
    # the first feed again: it is not what the last load of that month held
    assert [(r.nav, r.date) for r in nl.ingest_nav(feed, path, load_id=5).collect()] == [(45.0, day(35))]
    assert {r.nav for r in nl.nav_as_of(nl.read_table(spark, path)).where(F.col("date") == day(35)).collect()} == {45.0}


def test_load_that_broke_off_is_compared(spark, monkeypatch):
    from navlib.sources import store

    path = scratch_path(spark, "nav")
    one, two = _nav(spark, ("a", "A", 1.0, 0)), _nav(spark, ("a", "A", 2.0, 0))
    nl.ingest_nav(one, path, load_id=1)
    log = store._log_load

    def dies(spark, nav_path, step, load_id, months):
        if any(m[0] is not None for m in months.values()):
            raise RuntimeError("lost")
        log(spark, nav_path, step, load_id, months)

    with monkeypatch.context() as m:
        m.setattr(store, "_log_load", dies)
        try:
            nl.ingest_nav(two, path, load_id=2)
        except RuntimeError:
            pass
    assert nl.read_table(spark, path).count() == 2  # appended, but not logged
    assert nl.ingest_nav(one, path, load_id=3).count() == 1
    assert [r.nav for r in nl.nav_as_of(nl.read_table(spark, path)).collect()] == [1.0]


def test_empty_batches(spark):
    path = scratch_path(spark, "nav")
    empty = _nav(spark, ("a", "A", 1.0, 0)).limit(0)
    assert nl.ingest_nav(empty, path, load_id=1, newest_path=path + "_newest").count() == 0
    assert nl.ingest_nav(_nav(spark, ("a", "A", 1.0, 0)), path, load_id=2, newest_path=path + "_newest").count() == 1
    assert nl.ingest_nav(empty, path, load_id=3, newest_path=path + "_newest").count() == 0
    assert nl.read_newest(spark, path + "_newest").count() == 1


def _newest(spark, path):
    return {r.scheme_code: (r.nav, r.date, r.scheme_name) for r in nl.read_newest(spark, path).collect()}


def test_newest_rows_are_kept_by_increments(spark):
    import random

    rng = random.Random(4)
    path, newest = scratch_path(spark, "nav"), scratch_path(spark, "newest")
    for load in range(1, 7):
        rows = [(f"c{rng.randint(0, 30)}", f"N{load}", float(rng.randint(1, 99)), rng.randint(0, 60)) for _ in range(40)]
        rows = list({(c, d): (c, n, v, d) for c, n, v, d in rows}.values())
        nl.ingest_nav(_nav(spark, *rows), path, load_id=load, newest_path=newest)
        want = {r.scheme_code: (r.nav, r.date, r.scheme_name) for r in nl.latest_nav(nl.read_table(spark, path)).collect()}
        assert _newest(spark, newest) == want
    nl.refresh_newest(spark, newest, nl.read_table(spark, path), rebuild=True)
    assert _newest(spark, newest) == want


def test_only_buckets_with_newer_rows_are_rewritten(spark):
    newest = scratch_path(spark, "newest")
    files = lambda: set(nl.read_newest(spark, newest).inputFiles())
    nl.refresh_newest(spark, newest, _nav(spark, *[(f"c{i}", "N", 1.0, 50) for i in range(200)]), buckets=8)
    before = files()
    nl.refresh_newest(spark, newest, _nav(spark, *[(f"c{i}", "OLD", 2.0, 3) for i in range(200)]))
    assert files() == before and len(before) == 8  # a backfill rewrites nothing
    nl.refresh_newest(spark, newest, _nav(spark, ("c7", "NEW", 3.0, 51)), buckets=64)
    after = files()
    assert len(after) == 8 and len(after & before) == 7
    assert _newest(spark, newest)["c7"] == (3.0, day(51), "NEW") and len(_newest(spark, newest)) == 200


def test_lookups_scan_no_nav(spark):
    from navlib.plans.inspect import plan_text

    path, newest, master = (scratch_path(spark, n) for n in ("nav", "newest", "master"))
    feed = _nav(spark, *[(f"c{i}", f"Fund {i % 3}", float(i), i) for i in range(30)])
    nl.ingest_nav(feed, path, master, load_id=1, newest_path=newest)
    m, n, nav = nl.read_table(spark, master), nl.read_newest(spark, newest), nl.read_table(spark, path)
    for by_newest, by_nav in (
        (nl.search_schemes(m, "fund 1", newest=n), nl.search_schemes(m, "fund 1", nav=nav)),
        (nl.schemes_by_fund_house(m, "h", newest=n), nl.schemes_by_fund_house(m, "h", nav=nav)),
        (nl.schemes_by_category(m, "2", newest=n), nl.schemes_by_category(m, "2", nav=nav)),
        (nl.fund_houses(m, newest=n), nl.fund_houses(m, nav)),
        (nl.scheme_details(m, newest=n), nl.scheme_details(m, nav)),
    ):
        assert sorted(map(tuple, by_newest.collect())) == sorted(map(tuple, by_nav.collect()))
        text = plan_text(by_newest)
        assert path not in text and newest in text
        assert path in plan_text(by_nav)


def test_profile_from_footers(spark, sf_small):
    from navlib.operators.master import with_partition_columns
    from navlib.plans.inspect import plan_text
    from navlib.sources import store

    path = scratch_path(spark, "nav")
    nl.write_table(with_partition_columns(fx.nav_s(spark, sf_small)), path, ["year", "month"], "overwrite")
    df = spark.read.parquet(path)
    assert nl.stored_profile(spark, path).collect() == nl.table_profile(df).collect()
    assert sorted(nl.stored_partitions(spark, path).collect()) == sorted(nl.table_partitions(df).collect())
    assert nl.stored_range(spark, path).collect() == nl.nav_range(df).collect()
    assert nl.stored_latest_date(spark, path).collect() == nl.latest_nav_date(df).collect()
    assert "PushedAggregation: [COUNT(*)]" in plan_text(nl.stored_profile(spark, path))
    assert "PushedAggregation: [COUNT(*)]" in plan_text(nl.stored_partitions(spark, path))
    text = plan_text(nl.nav_range(store._by_metadata(spark, path)))
    assert "PushedAggregation: [COUNT(*), MIN(nav), MAX(nav), MIN(date), MAX(date)]" in text
    # the session's own reader is as before
    assert "PushedAggregation" not in plan_text(nl.table_profile(spark.read.parquet(path)))


def test_range_without_statistics(spark):
    path = scratch_path(spark, "nav")
    nl.write_table(_nav(spark, ("a", "A", None, 0), ("b", "B", None, 4)), path)
    assert nl.stored_range(spark, path).collect()[0] == (2, None, None, day(0), day(4))
    nl.write_table(_nav(spark, ("c", "C", float("nan"), 2), ("d", "D", 3.0, 9)), path)
    got, want = nl.stored_range(spark, path).collect()[0], nl.nav_range(spark.read.parquet(path)).collect()[0]
    assert (got.rows, got.min_nav, got.latest_date) == (4, 3.0, day(9)) and str(got) == str(want)


@pytest.mark.parametrize("crash_at", [0, 1, 2, 3])
def test_master_survives_a_crash_at_every_step(spark, monkeypatch, crash_at):
    """The refresh dies before its n-th file operation: the old or the new master is there, and the next refresh is right."""
    from navlib.sources import store

    path = scratch_path(spark, "master")
    names = lambda: {r.scheme_code: r.scheme_name for r in nl.read_table(spark, path).collect()}
    nl.refresh_master(spark, path, _nav(spark, ("a", "A", 1.0, 0)))
    real, steps = store._files, []

    class Dying:
        def __init__(self, files):
            self.files = files

        def exists(self, at):
            return self.files.exists(at)

        def __getattr__(self, name):  # rename, delete
            steps.append(name)
            if len(steps) == crash_at + 1:
                raise RuntimeError("lost")
            return getattr(self.files, name)

    def files(spark, path):
        found, at = real(spark, path)
        return Dying(found), at

    with monkeypatch.context() as m:
        m.setattr(store, "_files", files)
        with pytest.raises(RuntimeError):
            nl.refresh_master(spark, path, _nav(spark, ("b", "B", 1.0, 0)))
            raise RuntimeError("not enough steps")
    store.finish_replacement(spark, path)
    assert names() in ({"a": "A"}, {"a": "A", "b": "B"})
    nl.refresh_master(spark, path, _nav(spark, ("b", "B", 1.0, 0), ("c", "C", 1.0, 0)))
    assert names() == {"a": "A", "b": "B", "c": "C"}
    found, at = real(spark, path)
    assert not found.exists(at(f"{path}_next")) and not found.exists(at(f"{path}_old"))


def test_newest_version_carries_each_value_once(spark):
    rows = [("1", "n", "h", day(0), 5.0, 1), ("1", "m", None, day(0), 4.0, 2), ("1", "z", "h", day(0), 4.0, 2), ("2", None, "h", day(1), 1.0, 1)]
    nav = spark.createDataFrame(rows, "scheme_code string, scheme_name string, fund_house string, date date, nav double, load_id bigint")
    newest, kept = nl.nav_as_of(nav), nl.deduplicate_nav(nav)
    assert newest.columns == nav.columns and set(kept.columns) == set(nav.columns)
    assert {tuple(r) for r in newest.collect()} == {rows[2], rows[3]}
    assert {tuple(r) for r in kept.select(*nav.columns).collect()} == {rows[0], rows[3]}
    assert "max_by" not in newest._jdf.queryExecution().analyzed().toString() + kept._jdf.queryExecution().analyzed().toString()
