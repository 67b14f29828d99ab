"""Executed-plan summary of every registered job (after adaptive re-planning).

    python tools/plan_report.py /root/testdata/sf0.1 > PLANS.md

Counts per job: shuffles (hash / range / round-robin exchanges), broadcast
exchanges, Parquet scans, sort-merge and broadcast-hash joins, Python
operators (Arrow batches), and whether any cartesian product appears.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakegraph.plans import catalog  # noqa: E402

from lakegraph.session import get_spark  # noqa: E402


def summarize(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]     # the final adaptive plan only
    def n(pat):
        return len(re.findall(pat, plan))
    return {
        "shuffles": n(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)"),
        "broadcasts": n(r"BroadcastExchange"),
        "scans": n(r"FileScan parquet|Scan parquet"),
        "smj": n(r"SortMergeJoin"),
        "bhj": n(r"BroadcastHashJoin"),
        "python": n(r"MapInPandas|ArrowEvalPython|BatchEvalPython"),
        "cartesian": n(r"CartesianProduct|BroadcastNestedLoopJoin"),
        "single_partition": n(r"Exchange SinglePartition"),
        "skew_splits": n(r"skew=true|isSkewJoin=true"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=16)
    print("# Executed plans\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], 16 shuffle partitions, AQE on).")
    print("Counts are taken from the final adaptive plan after one full execution; a")
    print("job that runs helper jobs (bounds, query fetch, written intermediates) shows")
    print("only its final plan.\n")
    print("| job | shuffles | broadcasts | scans | SMJ | BHJ | python | cartesian |")
    print("|---|---|---|---|---|---|---|---|")
    # (shuffles counts exchanges in the final plan, including those AQE later
    # reads as coalesced or local; broadcasts include runtime conversions)
    for name, fn in catalog.JOBS.items():
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()                 # run this frame's own adaptive plan to the end
        plan = qe.executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['scans']} | {s['smj']} | "
              f"{s['bhj']} | {s['python']} | {s['cartesian']} |", flush=True)
    print(NOTES)
    spark.stop()


NOTES = """
Notes

- Shuffles are counted, not weighed: most exchanges above carry partially
  aggregated data. `dangling_refs` shuffles only per-key reference counts;
  `quantiles_exact` shuffles (value, count) pairs, then small per-range totals.
- Broadcasts are fixed-size dimensions (nation, region), bounded frames
  (histogram bins, quantile range totals, checked lookups) or AQE's run-time
  choice for sides it measured as small.
- Python appears only in the vector jobs (Arrow batches: top-k kernel in
  `knn_exact` and `knn_lsh`).
- Per-stage time, task count and shuffle bytes per job: run bench.py with
  BENCH_EVENT_LOG and read it with tools/stage_times.py.
"""


if __name__ == "__main__":
    main()
