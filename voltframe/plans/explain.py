"""Plan-shape report for the catalogue queries.

Runs each query (``noop`` sink), takes the final adaptive plan and counts
what matters at scale: scans (columns read, pushed filters), shuffles,
broadcasts, join strategies, aggregates, windows and Python operators.

    python -m voltframe.plans.explain /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter

OPS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
       "Generate", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]


def plan_text(df) -> str:
    """Final adaptive plan: execute the DataFrame's own QueryExecution (a
    ``write`` would plan and run a different one) and keep the part after
    ``== Final Plan ==``."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    text = qe.executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def summarize(plan: str) -> dict:
    c = Counter()
    for op in OPS:
        c[op] = len(re.findall(rf"\b{op}\b", plan))
    c["shuffles"] = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange SinglePartition|Exchange RoundRobinPartitioning", plan))
    c["broadcasts"] = len(re.findall(r"BroadcastExchange", plan))
    c["reused"] = len(re.findall(r"ReusedExchange", plan))
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        loc = re.search(r"/([A-Za-z_]+)\.parquet\]", line)
        rs = re.search(r"ReadSchema: struct<([^>]*)>", line)
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        cols = [x.split(":")[0] for x in rs.group(1).split(",")] if rs and rs.group(1) else []
        scans.append({"table": loc.group(1) if loc else "?", "columns": cols,
                      "pushed": pf.group(1) if pf else ""})
    return {"ops": c, "scans": scans}


def report(spark, sf_dir: str, names=None) -> str:
    from voltframe.plans.catalog import QUERIES
    out = ["# Plan shapes", "",
           f"Final adaptive plans (after AQE re-planning) of every catalogue query over `{sf_dir}` "
           "(generated by `python -m voltframe.plans.explain`). Counts are per query; "
           "`scans` lists each parquet scan with the columns it reads.", "",
           "| Query | shuffles | reused | broadcasts | joins (BHJ/SMJ/SHJ/BNLJ) | aggs (hash/sort/obj) | windows | "
           "python ops | scans (table: columns) |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name in names or list(QUERIES):
        s = summarize(plan_text(QUERIES[name](spark, sf_dir)))
        o = s["ops"]
        py = o["BatchEvalPython"] + o["ArrowEvalPython"] + o["MapInPandas"] + o["FlatMapGroupsInPandas"]
        scans = "; ".join(f"{x['table']}: {len(x['columns'])} cols"
                          + (f" [pushed: {x['pushed']}]" if x["pushed"] else "") for x in s["scans"])
        out.append(f"| `{name}` | {o['shuffles']} | {o['reused']} | {o['broadcasts']} | "
                   f"{o['BroadcastHashJoin']}/{o['SortMergeJoin']}/{o['ShuffledHashJoin']}/"
                   f"{o['BroadcastNestedLoopJoin'] + o['CartesianProduct']} | "
                   f"{o['HashAggregate']}/{o['SortAggregate']}/{o['ObjectHashAggregate']} | {o['Window']} | "
                   f"{py} | {scans} |")
    return "\n".join(out) + "\n"


if __name__ == "__main__":
    from voltframe.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    print(report(spark, sf, sys.argv[2:] or None), end="")
