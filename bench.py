"""Benchmark: ETL (transform + load) and the 18 analytical queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. The ETL writes the warehouse to a scratch folder
(the session's checkpoint folder when one is configured); the queries then
read that warehouse, as they would in production.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerstar.oracle import TEST_SALT
    from ledgerstar.plans import analytics, jobs
    from ledgerstar.session import build_spark
    from ledgerstar.sources.raw import raw_transactions

    spark = build_spark("ledgerstar-bench", master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    spark.sparkContext.setLogLevel("ERROR")
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    base = conf_dir or tempfile.mkdtemp(prefix="ledgerstar-bench-")
    run = f"{base.rstrip('/')}/bench-{os.getpid()}"
    timings: dict[str, float] = {}

    def etl_and_queries(src: str, dest: str, timed: bool) -> None:
        t0 = time.time()
        jobs.run_transform(raw_transactions(spark, src), f"{dest}/staging", TEST_SALT)
        if timed:
            timings["etl_transform"] = time.time() - t0
        t0 = time.time()
        staged = jobs.read_staged(spark, f"{dest}/staging")
        jobs.run_load(spark, staged, f"{dest}/warehouse", "2024-02-01 00:00:00")
        if timed:
            timings["etl_load"] = time.time() - t0
        t0 = time.time()  # the same staging again: type-2 merge, day replacement
        jobs.run_load(spark, staged, f"{dest}/warehouse", "2024-03-01 00:00:00")
        if timed:
            timings["etl_second_load"] = time.time() - t0
        wh = jobs.read_warehouse(spark, f"{dest}/warehouse")
        for name, fn in analytics.QUERIES.items():
            t0 = time.time()
            fn(wh).collect()
            if timed:
                timings[name] = time.time() - t0

    # untimed warm-up on the smallest scale (JIT and code generation), then
    # the measured run on the requested scale
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        etl_and_queries(warm, f"{run}-warmup", timed=False)
    etl_and_queries(sf_dir, run, timed=True)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "etl_plus_18_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "warmup": bool(warm and os.path.isdir(warm)),
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
