"""Benchmark: every operator over whole stored NAV tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1; the median is reported), BENCH_WARMUP (default 0).  The NAV views are built
from the driver's tables once and stored as Parquet partitioned by
(year, month), as the library stores NAV; each query then reads the stored
tables and is fully materialised with the ``noop`` sink.  Queries that write
(ingest, refresh, compaction, streaming) run from the registry, over the
driver's tables.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import navlib as nl  # noqa: E402
from navlib.operators.master import with_partition_columns  # noqa: E402
from navlib.operators.returns import period_performance  # noqa: E402
from navlib.plans import registry as R  # noqa: E402
from navlib.session import local_session  # noqa: E402
from navlib.sources import fixtures as fx  # noqa: E402
from navlib.sources.store import scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "1"))
ROWS = os.environ.get("BENCH_ROWS", "0") == "1"  # also count result rows (untimed)
# BENCH_REST=0 leaves out the other registered queries, writers included.
REST = os.environ.get("BENCH_REST", "1") == "1"
# BENCH_WARMUP=1: one untimed pass over every operator first (JIT, Python
# workers).  Off by default: with 35 query shapes the generated-code cache
# (100 entries) is evicted anyway, so it buys little; repeats (BENCH_REPEAT)
# of one query are what show the steady state.
WARMUP = os.environ.get("BENCH_WARMUP", "0") == "1"


def _sf(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def store_views(spark):
    """Build the NAV-shaped views once and store them like the library stores NAV."""
    out = {}
    for name in ("nav_s", "nav_p", "nav_t", "nav_ticks", "nav_stale"):
        path = scratch_path(spark, name)
        nl.write_table(with_partition_columns(fx.BUILDERS[name](spark, SF_DIR)), path, ["year", "month"], "overwrite")
        out[name] = spark.read.parquet(path)
    for name in ("master_p", "master_renamed", "feed_lines"):
        path = scratch_path(spark, name)
        nl.write_table(fx.BUILDERS[name](spark, SF_DIR), path, mode="overwrite")
        out[name] = spark.read.parquet(path)
    # ingest keeps this table beside NAV; lookups read it
    newest = scratch_path(spark, "newest_p")
    nl.refresh_newest(spark, newest, out["nav_p"])
    out["newest_p"] = nl.read_newest(spark, newest)
    return out


def bench_queries(t):
    corr = dict(codes="all", since=None, min_overlap=R.MIN_OVERLAP)
    return {
        "parse_nav_text": lambda: nl.parse_nav_text(t["feed_lines"]),
        "nav_as_of": lambda: nl.nav_as_of(t["nav_ticks"], load_id=3, tie_cols=("tie", "nav")),
        "scheme_master": lambda: nl.scheme_master(t["nav_s"]),
        "nav_on_date": lambda: nl.nav_on_date(t["nav_s"], R.ON_DATE),
        "nav_between": lambda: nl.nav_between(t["nav_s"], R.RANGE_START, R.RANGE_END),
        "search_schemes": lambda: nl.search_schemes(t["master_p"], R.KEYWORD, newest=t["newest_p"]),
        "schemes_by_category": lambda: nl.schemes_by_category(t["master_p"], R.KEYWORD, newest=t["newest_p"]),
        "scheme_details": lambda: nl.scheme_details(nl.scheme_master(t["nav_s"]), t["nav_p"]),
        "available_dates": lambda: nl.available_dates(t["nav_s"]),
        "nav_summary": lambda: nl.nav_summary(t["nav_s"], R.AS_OF),
        "dq_null_checks": lambda: nl.dq_null_checks(t["nav_ticks"]),
        "dq_duplicates": lambda: nl.dq_duplicates(t["nav_ticks"]),
        "dq_overall": lambda: nl.dq_overall(t["nav_ticks"]),
        "duplicate_codes": lambda: nl.duplicate_codes(t["master_renamed"]),
        "similar_names": lambda: nl.similar_names(t["master_p"]),
        "duplicate_summary": lambda: nl.duplicate_summary(t["master_p"]),
        "daily_returns": lambda: nl.daily_returns(t["nav_s"]),
        "period_returns": lambda: nl.period_returns(t["nav_s"], R.PERIODS),
        "scheme_performance": lambda: nl.scheme_performance(t["nav_s"], R.PERIODS),
        "compare_schemes": lambda: nl.compare_schemes(t["nav_s"], None, R.PERIOD),
        "top_performers": lambda: nl.top_performers(t["nav_s"], limit=R.TOP_LIMIT),
        "top_performers_in_category": lambda: nl.top_performers(
            t["nav_p"], t["master_p"], category=R.KEYWORD, limit=R.TOP_LIMIT
        ),
        "top_performer_statistics": lambda: nl.top_performer_statistics(period_performance(t["nav_s"], R.PERIOD)),
        "basic_volatility": lambda: nl.basic_volatility(t["nav_p"]),
        "rolling_volatility": lambda: nl.rolling_volatility(t["nav_s"], R.ROLLING_WINDOW),
        "risk_statistics": lambda: nl.risk_statistics(t["nav_p"]),
        "value_at_risk": lambda: nl.value_at_risk(t["nav_p"]),
        "volatility_regime": lambda: nl.volatility_regime(t["nav_p"]),
        "extreme_returns": lambda: nl.extreme_returns(t["nav_s"]),
        "nav_jumps": lambda: nl.nav_jumps(t["nav_s"]),
        "stale_nav": lambda: nl.stale_nav(t["nav_stale"]),
        "anomaly_summary": lambda: nl.anomaly_summary(t["nav_s"]),
        "most_observed_schemes": lambda: nl.most_observed_schemes(t["nav_s"], None, R.MIN_OVERLAP, R.TOP_K),
        "correlation_matrix": lambda: nl.correlation_matrix(t["nav_t"], **corr),
        "correlation_statistics": lambda: nl.correlation_statistics(t["nav_t"], **corr),
    }


def bench_rest(spark, done):
    """The registered queries that ``bench_queries`` lacks, from the driver's tables (not in the total)."""
    return {name: (lambda q=q: q(spark, SF_DIR)) for name, q in R.QUERIES.items() if name not in done}


def bench_reports(t):
    """Whole reports: every block materialised, the base computed once (not in the total)."""
    from navlib.plans import reports

    return {
        "volatility_report": lambda: reports.volatility_report(t["nav_p"]),
        "anomaly_report": lambda: reports.anomaly_report(t["nav_s"]),
        "correlation_report": lambda: reports.correlation_report(t["nav_t"], "all", min_overlap=R.MIN_OVERLAP),
    }


def run_report(make) -> float:
    t0 = time.perf_counter()
    for block in make().values():
        block.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def run(make) -> float:
    t0 = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    spark = local_session(CPUS, max(8, 2 * CPUS), app="navlib-bench")
    t0 = time.perf_counter()
    tables = store_views(spark)
    prep = time.perf_counter() - t0
    qs = bench_queries(tables)
    if WARMUP:
        for make in qs.values():
            run(make)
    else:
        run(qs["daily_returns"])  # first-job costs only
    times = {}
    for name, make in qs.items():
        times[name] = round(statistics.median(run(make) for _ in range(REPEAT)), 3)
    total = round(sum(times.values()), 3)
    report_times = {
        name: round(statistics.median(run_report(make) for _ in range(REPEAT)), 3)
        for name, make in bench_reports(tables).items()
    }
    rest = {name: round(run(make), 3) for name, make in bench_rest(spark, qs).items()} if REST else {}
    rows = tables["nav_s"].count()
    rows_out = {name: make().count() for name, make in qs.items()} if ROWS else None
    print(
        json.dumps(
            {
                "metric": "total_operator_sec",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": _sf(SF_DIR),
                "cpus": CPUS,
                "prep_sec": round(prep, 3),
                "nav_s_rows": rows,
                "warmup": "one untimed pass over all operators" if WARMUP else "none (cold)",
                "reports": report_times,
                "other_queries": rest,
                **({"rows_out": rows_out} if rows_out else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
