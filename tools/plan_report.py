"""Execute every registered query and summarise its final (AQE) physical plan.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Per query: exchanges, reused exchanges, broadcast / sort-merge joins, window
group limits (partial top-k), scans, scans with pushed filters, the widest
read schema, and whether Python runs in the plan.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_part(plan: str) -> str:
    """The final adaptive plan without the initial plan printed after it."""
    return plan.split("== Initial Plan ==")[0]


def summarise(plan: str) -> dict:
    plan = final_part(plan)
    scans = re.findall(r"FileScan parquet[^\n]*", plan)
    pushed = [s for s in scans if "PushedFilters: [" in s and "PushedFilters: []" not in s]
    widths = [len(m.split(",")) for s in scans for m in re.findall(r"ReadSchema: struct<([^>]*)>", s)]
    return {
        "exchanges": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "reused": plan.count("ReusedExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "wgl": plan.count("WindowGroupLimit"),
        "scans": len(scans),
        "pushed": len(pushed),
        "bucketed": sum("Bucketed: true" in s or "SelectedBucketsCount" in s for s in scans),
        "max_cols": max(widths) if widths else 0,
        "python": "ArrowEvalPython" in plan or "FlatMapGroupsInArrow" in plan or "FlatMapGroupsInPandas" in plan,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from candlewick.session import get_spark

    spark = get_spark("local[8]", app="candlewick-plans", shuffle_partitions=16, driver_memory="8g",
                      extra={"spark.ui.showConsoleProgress": "false"})
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="candlewick-plans-"))
    from candlewick.plans import registry

    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py {sf_dir}` (local[8], 16 shuffle partitions, AQE, bucketed layout).")
    print("Counts are taken from the final adaptive plan after execution. `exch` = shuffle exchanges, `bc` =")
    print("broadcast exchanges (AQE-chosen from measured sizes unless the side is a fixed-size frame), `wgl` =")
    print("WindowGroupLimit nodes (partial + final top-k), `pushed` = Parquet scans with pushed filters, `bkt` = scans")
    print("read as bucketed (no shuffle for per-code work), `cols` = widest read schema.\n")
    print("| query | exch | bc | reused | BHJ | SMJ | wgl | scans | pushed | bkt | cols | python |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    frames = {}
    for name, fn in registry.QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()  # runs this DataFrame's own execution, so executedPlan is the final AQE plan
        frames[name] = df
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {s['reused']} | {s['bhj']} | {s['smj']} | "
              f"{s['wgl']} | {s['scans']} | {s['pushed']} | {s['bucketed']} | {s['max_cols']} | "
              f"{'yes' if s['python'] else ''} |", flush=True)
    for name in DETAIL:
        plan = frames[name]._jdf.queryExecution().executedPlan().toString()
        print(f"\n## Final plan of `{name}`\n\n```")
        print(re.sub(r"#\d+L?", "", final_part(plan)).strip())
        print("```")
    spark.stop()


# queries whose final plan is printed in full
DETAIL = ["x11_industry_by_day", "x01_box_breakout", "x20_daily_refresh"]


if __name__ == "__main__":
    main()
