"""Benchmark: the whole report job (R1-R13) end to end.

Steps timed:
  base   - derive daily_report_base + store_lookup from the raw tables and
           write them (the job's input tables);
  R1-R13 - run_job over the written inputs: twelve wide reports and the long
           combined report, each written as Parquet.

Prints ONE JSON line.  Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_PARALLEL (periods at once, default 4; with 1
each table's time is its own).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storepulse.plans.reports import run_job  # noqa: E402
from storepulse.session import local_session  # noqa: E402
from storepulse.sources import derive_report_base, derive_store_lookup  # noqa: E402
from storepulse.sources.tables import read_report_base, read_store_lookup  # noqa: E402

AS_OF = "2001-08-01"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(cpus, app="storepulse-bench", extra={
        "spark.sql.shuffle.partitions": str(2 * int(cpus)),
        # Report rows are small but CPU-heavy (71 decimal columns each): keep
        # enough partitions after AQE coalescing to use every core.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    })

    queries: dict[str, float] = {}
    t0 = time.perf_counter()
    (derive_report_base(spark, sf_dir).repartition(int(cpus), "report_date")
     .write.mode("overwrite").parquet(f"{scratch}/in/daily_report_base"))
    derive_store_lookup(spark, sf_dir).write.mode("overwrite").parquet(f"{scratch}/in/store_lookup")
    queries["base"] = round(time.perf_counter() - t0, 3)

    base = read_report_base(spark, f"{scratch}/in/daily_report_base")
    lookup = read_store_lookup(spark, f"{scratch}/in/store_lookup")
    t1 = time.perf_counter()
    run_job(spark, base, lookup, f"{scratch}/out", as_of=AS_OF, timings=queries,
            parallel=int(os.environ.get("BENCH_PARALLEL", "4")))
    queries["reports_total"] = round(time.perf_counter() - t1, 3)
    total = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "report_job_wall", "value": total, "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
