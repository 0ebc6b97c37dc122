"""Write docs/PLANS.md: the executed physical plan shape of key queries.

For each query it runs the query (so the adaptive plan is final) and keeps the
operator lines that matter for scale -- scans with their read schema,
exchanges, joins, windows, aggregates -- indented as in the plan.

Usage: python tools/plan_summary.py [data_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmetrics.plans.catalog import QUERIES  # noqa: E402
from tripmetrics.session import build_session  # noqa: E402

KEY_QUERIES = ["daily_spine", "hourly_spine", "score_share", "running_totals", "heartbeat_outages",
               "widecol_project", "serving_kv", "trip_rejects"]
KEEP = re.compile(r"(Scan|Exchange|Reused|Join|Window|HashAggregate|Generate|CollectMetrics|Union|"
                  r"BroadcastQueryStage|ShuffleQueryStage|AQEShuffleRead)")


def summarize(plan: str) -> list[str]:
    final = plan.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    out = []
    for line in final.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        line = re.sub(r"(functions=\[)([^\]]{80})[^\]]*\]", r"\1\2...]", line)
        out.append(line.rstrip()[:190])
    return out


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    parts = ["# Executed plans of key queries",
             "",
             f"Generated by `tools/plan_summary.py` on `{data_dir}` (`local[8]`, AQE on). Only scans,",
             "exchanges, joins, windows, aggregates and metric nodes are kept.",
             ""]
    for name in KEY_QUERIES:
        df = QUERIES[name](spark, data_dir)
        df.collect()  # run this DataFrame's own query so its adaptive plan is final
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        parts += [f"## {name}", "", "```", *summarize(plan), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(parts))
    print(path)


if __name__ == "__main__":
    main()
