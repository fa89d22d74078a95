"""Benchmark the headline queries.

env:
  BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] threads (default 8)
  BENCH_QUERIES  comma-separated query keys (default: the headline set below)
  BENCH_EVENTLOG folder for Spark's event log (optional; for stage/task timings)
  BENCH_WARMUP_DIR  tables for one untimed warm-up pass of every query
                    (default /root/testdata/sf0.001 when present; "" disables)

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed completely with a ``noop`` write, so timings include
every stage but no transfer of results to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curdle.operators.materialize import release_staged  # noqa: E402
from curdle.plans.queries import all_queries  # noqa: E402
from curdle.session import build_session  # noqa: E402

HEADLINE = [
    "g01_coleta_fazenda_mensal",
    "g02_eficiencia_producao",
    "g03_logistica_sla",
    "g04_perdas_consolidado",
    "g05_resultado_mensal",
    "q05_suite_summary",
    "b05_flag_duplicates_in_batch",
    "s03_coletas",
    "s08_itens_pedido",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    extra = {"spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="curdle-bench-")}
    if os.environ.get("BENCH_EVENTLOG"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG"]})
    spark = build_session(f"local[{cpus}]", app_name="curdle-bench", shuffle_partitions=cpus * 2, extra_conf=extra)
    spark.sparkContext.setLogLevel("ERROR")
    registry = all_queries()

    # Warm-up, not counted: JIT and generated-code caches are filled by one pass
    # over the smallest tables, so timings reflect the work that grows with data.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and os.path.isdir(warm_dir):
        for name in names:
            registry[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        release_staged()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        release_staged()  # staged inputs of a finished query (not timed)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "warmup": warm_dir or None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
