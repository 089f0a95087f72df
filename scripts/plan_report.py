"""Summarise the physical plan of every registered table and join query (writes PLANS.md).

Usage: python scripts/plan_report.py [sf_dir] [out_file]

Automatic broadcast is turned off, as on large tables where no side's file
size is under the threshold; explicit broadcasts the library adds after
measuring a side still show.  The plan summarised is the one Spark starts
with (before adaptive re-planning).  Loading queries run their writes when
called and return a scan of the table, so for them the write job is what
matters; their plan shapes are described in the README.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableworks.plans.inspect import plan_text  # noqa: E402
from tableworks.session import local_session  # noqa: E402

# Patterns over the node details of ``explain("formatted")``: one match per node.
MARKERS = {
    "shuffle": r"^\(\d+\) Exchange\n(?:[^\n]+\n)*?Arguments: hashpartitioning",
    "range shuffle": r"^\(\d+\) Exchange\n(?:[^\n]+\n)*?Arguments: rangepartitioning",
    "broadcast": r"^\(\d+\) BroadcastExchange\b",
    "sort-merge join": r"^\(\d+\) SortMergeJoin\b",
    "broadcast hash join": r"^\(\d+\) BroadcastHashJoin\b",
    "nested loop": r"^\(\d+\) BroadcastNestedLoopJoin\b",
    "cartesian": r"^\(\d+\) CartesianProduct\b",
    "python": r"^\(\d+\) (BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)\b",
    "explode": r"^\(\d+\) Generate\b(?:[^\n]*\n)*?Arguments: explode",
}


def summarise(text: str) -> dict[str, int | str]:
    out: dict[str, int | str] = {k: len(re.findall(p, text, re.M)) for k, p in MARKERS.items()}
    scans = re.findall(r"^\(\d+\) Scan parquet[^\n]*\n(.*?)\n\n", text, re.S | re.M)
    pushed = sum(1 for s in scans if re.search(r"PushedFilters: \[.+\]", s) or "PartitionFilters: [" in s)
    out["scans"] = len(scans)
    out["scans with pushed filters"] = pushed
    return out


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(sys.argv[0]) or ".", "..", "PLANS.md")
    from tableworks.plans.workloads import QUERIES

    spark = local_session(8, 8, warehouse_dir=tempfile.mkdtemp(prefix="tw-plans-", dir="/tmp"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        s = summarise(plan_text(df))
        rows.append((name, s))
        print(name, s, file=sys.stderr)
    spark.stop()

    cols = ["shuffle", "range shuffle", "broadcast", "sort-merge join", "broadcast hash join",
            "nested loop", "cartesian", "python", "explode", "scans", "scans with pushed filters"]
    lines = [
        "# Plans of the registered queries",
        "",
        "Generated by `python scripts/plan_report.py` at sf0.01. Automatic broadcast is off, as on",
        "large tables where no side's file size is under the threshold; the broadcasts shown are the",
        "library's own, each made after measuring that side. Counts are nodes in the plan Spark starts",
        "with (before adaptive re-planning). Loading queries run their write when called and return a",
        "scan of the result, so their rows show only that scan; the README describes their write jobs.",
        "The corpus operators write and read tables as they go and are not listed; the check tool's",
        "figures for their stages are in the README.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "|---|" + "---|" * len(cols),
    ]
    for name, s in rows:
        lines.append(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    lines += [
        "",
        "Reading the table:",
        "",
        "* No query plans a cartesian product or a Python node.",
        "* No query plans a nested-loop join. (`range_join` without keys does where one side was",
        "  measured small and is broadcast; otherwise it is a binned equi-join, `join_range_binned`.)",
        "  Points in intervals, overlapping ranges, bands and alternatives of keys are equi-joins, also when",
        "  they come as condition text.",
        "* `join_range_semi` and `join_range_anti` join one aggregated row per key; no pairs.",
        "* Full outer joins (`join_full_outer`, `join_coalesce`) shuffle each side once: one full outer",
        "  join, beside rows with NULL keys, which are not shuffled. The keys here are not hot; with",
        "  hot keys their rows are joined apart (`tests/test_hot_keys.py` reads the shuffled rows).",
        "* `join_coalesce_many` has one shuffle for three frames and no join.",
        "* `load_merge_upsert_bitmap` broadcasts the bitmap of the batch's keys; target rows that pass",
        "  it are the only ones of the target in the join's shuffle.",
        "* `join_multi_table` shuffles `nation` (25 rows) only because automatic broadcast is off in",
        "  this report. Under the default threshold Catalyst broadcasts it from its file size, and AQE",
        "  does the same from measured shuffle sizes. The other joins there and in `query_discount`",
        "  shuffle `customer`, `orders`, `lineitem` and `part` on their keys, which is the right plan",
        "  when those tables are large.",
        "* `query_order_amounts` aggregates `lineitem` on the order key before the join. The join",
        "  reuses that partitioning, so there is no third hash shuffle; the range shuffle is the global",
        "  `ORDER BY`.",
        "* `join_bucketed` joins two bucketed tables without any exchange.",
        "* Every scan with a filter in the query shows it as `PushedFilters` or `PartitionFilters`.",
        "  The scans without one read whole tables on purpose, for example every customer in",
        "  `join_left`.",
        "",
    ]
    with open(out_file, "w") as fh:
        fh.write("\n".join(lines))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
