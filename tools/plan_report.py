"""Write PLANS.md: the physical-plan shape of every benchmarked operator.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
Explains each bench query over stored, partitioned views (no execution of
the query itself; operators that materialise a base do so while planning).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from navlib.plans.inspect import plan_text  # noqa: E402
from navlib.session import local_session  # noqa: E402


def summarize(text: str) -> dict:
    tree = text.split("\n\n(")[0]
    return {
        "exchanges": len(re.findall(r"\bExchange \(", tree)),
        "subqueries": len(set(re.findall(r"Subquery subquery#(\d+)", text))),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn", text)),
        "partition_filters": "PartitionFilters: [" in text and not re.search(r"PartitionFilters: \[\]", text),
        "pushed_filters": bool(re.search(r"PushedFilters: \[[^\]]", text)),
        "broadcast": len(re.findall(r"BroadcastExchange|BroadcastHashJoin", tree)),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    bench.SF_DIR = sf_dir
    spark = local_session(8, 16, app="navlib-plans")
    tables = bench.store_views(spark)
    lines = [
        "# PLANS — physical-plan shape per operator",
        "",
        f"Generated by `tools/plan_report.py` over stored views of `{sf_dir}` (NAV partitioned by year/month).",
        "Columns: exchanges in the main plan; distinct scalar subqueries (planned apart, each run once: AQE",
        "reuses identical ones and merges those over the same plan); Python nodes; whether partition / pushed",
        "filters reach the scan; broadcast nodes (chosen by Catalyst's size threshold, or explicit over",
        "bounded sides).",
        "",
        "| operator | exchanges | scalar subqueries | python | partition filters | pushed filters | broadcast |",
        "|---|---|---|---|---|---|---|",
    ]
    for name, make in bench.bench_queries(tables).items():
        s = summarize(plan_text(make()))
        lines.append(
            f"| {name} | {s['exchanges']} | {s['subqueries']} | {s['python']} | {'yes' if s['partition_filters'] else '-'} | "
            f"{'yes' if s['pushed_filters'] else '-'} | {s['broadcast']} |"
        )
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
