"""Physical-plan audit of every registered query (developer tool).

Runs each query into the ``noop`` sink and reads the final adaptive plan: scans per table,
shuffles, single-partition exchanges, broadcasts, join strategies, windows and any Python
evaluation. The plans of the intermediates that a query materialises while it is built are included. ``python -m ledgerlens.plans.audit [sf_dir] > PLAN_AUDIT.md``.
"""

from __future__ import annotations

import collections
import re
import sys

NODES = {
    "shuffle": r"Exchange hashpartitioning",
    "range_shuffle": r"Exchange rangepartitioning",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "reused": r"Reused(Exchange|QueryStage)",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "window": r"\bWindow \[",
    "group_limit": r"WindowGroupLimit",
    "python": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
}


def final_plan(df) -> str:
    plan = df._jdf.queryExecution().executedPlan()
    try:
        return plan.executedPlan().toString()  # AdaptiveSparkPlanExec -> final plan
    except Exception:
        return plan.toString()


def audit(spark, sf_dir: str, names=None):
    from .. import session
    from .catalog import load

    reg = load()
    rows = []
    for n in names or sorted(reg):
        plans: list[str] = []
        session.recorder = lambda df, plans=plans: plans.append(final_plan(df))
        try:
            df = reg[n].build(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
        finally:
            session.recorder = None
        txt = "\n".join([*plans, final_plan(df)])
        scans = collections.Counter(re.findall(r"InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*/([a-z_]+)\.parquet", txt))
        counts = {k: len(re.findall(p, txt)) for k, p in NODES.items()}
        rows.append((n, dict(scans), counts))
    return rows


def main() -> None:
    from ..session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, app="ledgerlens-audit")
    rows = audit(spark, sf_dir)
    cols = list(NODES)
    print(f"# Plan audit ({sf_dir}, final adaptive plans)\n")
    print("Each row adds up the query's own plan and those of the intermediates it materialises (their reads are not scans).\n")
    print("| query | table scans | " + " | ".join(cols) + " |")
    print("| --- | --- | " + " | ".join("---" for _ in cols) + " |")
    for n, scans, c in rows:
        s = ", ".join(f"{t}×{k}" if k > 1 else t for t, k in sorted(scans.items())) or "-"
        print(f"| `{n}` | {s} | " + " | ".join(str(c[k]) for k in cols) + " |")
    tot = collections.Counter()
    for _, _, c in rows:
        tot.update(c)
    print("\nTotals: " + ", ".join(f"{k}={tot[k]}" for k in cols))


if __name__ == "__main__":
    main()
