"""Benchmark: every registered query on $BENCH_SF_DIR, local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no collection
to the driver): one warm-up run, then the median of ``$BENCH_RUNS`` (3)
timed runs. Prints one JSON line: total of medians plus per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakemart.plans.registry import load_all  # noqa: E402
from lakemart.session import get_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [a for a in sys.argv[1:]]
    # local mode runs everything in the driver JVM; its heap can be raised for larger scale factors
    mem = os.environ.get("BENCH_DRIVER_MEMORY")
    spark = get_session(f"local[{cpus}]", app="lakemart-bench", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": mem} if mem else None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakemart-bench-ckpt-"))
    reg = load_all()
    per: dict[str, float] = {}
    failed: list[str] = []
    for name, entry in reg.items():
        if only and name not in only:
            continue
        try:
            run(entry.fn(spark, sf_dir))  # warm-up
            times = []
            for _ in range(runs):
                t0 = time.perf_counter()
                run(entry.fn(spark, sf_dir))
                times.append(time.perf_counter() - t0)
            per[name] = round(statistics.median(times), 4)
        except Exception as exc:  # report, keep going
            failed.append(f"{name}: {type(exc).__name__}")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(per.values()), 3), "unit": "sec",
           "queries": per, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "n_queries": len(per), "cpus": int(cpus), "runs": runs}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
