"""Summarise the executed (AQE final) plans of the analytical queries.

Usage: python tools/plan_report.py [sf_dir]   (writes a markdown table)
"""

from __future__ import annotations

import re
import sys
import tempfile

sys.path.insert(0, ".")


def final_only(plan: str) -> str:
    """The AQE final plan (the string also carries the initial plan)."""
    return plan.split("== Initial Plan ==")[0]


def summarise(plan: str) -> dict:
    plan = final_only(plan)
    lines = plan.splitlines()
    hash_ex = sum(1 for ln in lines if "Exchange hashpartitioning" in ln)
    range_ex = sum(1 for ln in lines if "Exchange rangepartitioning" in ln)
    single = sum(1 for ln in lines if "Exchange SinglePartition" in ln)
    bcast = sum(1 for ln in lines if "BroadcastExchange" in ln)
    fact_cols = set()
    for ln in lines:
        if "FileScan parquet" in ln and "fact_transactions" in ln:
            m = re.search(r"FileScan parquet \[([^\]]*)\]", ln)
            if m:
                fact_cols |= {c.split("#")[0] for c in m.group(1).split(",")}
    return {
        "shuffles (hash/range)": f"{hash_ex}/{range_ex}",
        "single-partition": single,
        "broadcasts": bcast,
        "fact columns read": ", ".join(sorted(fact_cols)),
        "WindowGroupLimit": "yes" if "WindowGroupLimit" in plan else "",
        "partial agg": "yes" if "partial_" in plan else "",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from ledgerstar.oracle import TEST_SALT
    from ledgerstar.plans import analytics, jobs
    from ledgerstar.session import build_spark
    from ledgerstar.sources.raw import raw_transactions
    spark = build_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="ledgerstar-plans-")
    jobs.run_transform(raw_transactions(spark, sf_dir), f"{root}/staging", TEST_SALT)
    jobs.run_load(spark, jobs.read_staged(spark, f"{root}/staging"), f"{root}/wh",
                  "2024-02-01 00:00:00")
    wh = jobs.read_warehouse(spark, f"{root}/wh")
    rows = []
    for name, fn in analytics.QUERIES.items():
        df = fn(wh)
        df.collect()
        rows.append((name, summarise(df._jdf.queryExecution().executedPlan().toString())))
    cols = list(rows[0][1])
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
