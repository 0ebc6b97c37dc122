"""Benchmark: every registered query on one data folder.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8); optional ``BENCH_QUERIES`` (comma list) and ``BENCH_JAVA_OPTS``
(extra driver JVM options, for tuning experiments).  The ``events`` file of the folder is one
row group, which only one task can read; it is first written, outside the timings, into
``BENCH_FILES`` files (default twice the cores), as any stored table of size would be.  Each query runs to completion through the ``noop`` sink (full
plan executed, nothing collected to the driver).  A warm-up pass on the
smallest folder compiles the generated code first, so the timings measure
steady-state execution rather than JIT and code generation.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tripmetrics.plans.catalog import QUERIES  # noqa: E402
from tripmetrics.session import build_session  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"


def _run(spark, name, data_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(QUERIES)
    extra = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    if os.environ.get("BENCH_JAVA_OPTS"):
        extra["spark.driver.extraJavaOptions"] = os.environ["BENCH_JAVA_OPTS"]
    spark = build_session(f"local[{cpus}]", cpus, app_name="tripmetrics-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    t_warm = time.perf_counter()
    if os.path.isdir(WARMUP_DIR):
        for name in names:
            _run(spark, name, WARMUP_DIR)
    warmup_s = time.perf_counter() - t_warm

    timings = {}
    stored = tempfile.mkdtemp(prefix="tripmetrics-bench-")
    files = int(os.environ.get("BENCH_FILES", 2 * cpus))
    spark.read.parquet(f"{data_dir}/events.parquet").repartition(files).write.parquet(f"{stored}/events.parquet")
    m = re.search(r"sf([0-9.]+)", data_dir)
    data_dir = stored
    for name in names:
        timings[name] = round(_run(spark, name, data_dir), 3)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "warmup_sec": round(warmup_s, 3),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
