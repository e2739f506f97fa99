"""Command line: ``python -m ledgerstar {transform,load,query,sql} ...``.

transform  raw CSV (local or any Hadoop-FS URI) -> validated staging Parquet;
           the masking salt is read from MASKING_SALT and is required
load       staging Parquet -> warehouse (dates, merchants, accounts, facts)
query      run one of the named analytical queries on a warehouse
sql        run a SQL script against the warehouse tables (as views)
"""

from __future__ import annotations

import argparse
import datetime
import os
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerstar")
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="upper bound; adaptive execution coalesces at runtime")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("transform")
    t.add_argument("--input", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--skip-validation", action="store_true")
    t.add_argument("--strict-types", action="store_true")
    ld = sub.add_parser("load")
    ld.add_argument("--input", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--batch-ts", default=None, help="default: now (UTC)")
    q = sub.add_parser("query")
    q.add_argument("--warehouse", required=True)
    q.add_argument("name")
    q.add_argument("--limit", type=int, default=100, help="rows to print")
    q.add_argument("--output", default=None, help="write the whole result as Parquet to this folder")
    s = sub.add_parser("sql")
    s.add_argument("--warehouse", required=True)
    s.add_argument("script")
    s.add_argument("--limit", type=int, default=100, help="rows to print per statement")
    s.add_argument("--output", default=None, help="write each statement's whole result as Parquet to a folder n=1, n=2 ... in this one")
    a = p.parse_args(argv)

    salt = os.environ.get("MASKING_SALT")
    if a.cmd == "transform" and not salt:
        print("MASKING_SALT is not set: it must stay the same across runs and never be "
              "committed; set it in the environment.", file=sys.stderr)
        return 1

    from .plans import analytics, jobs
    from .session import build_spark
    spark = build_spark(master=a.master, shuffle_partitions=a.shuffle_partitions)
    try:
        if a.cmd == "transform":
            from .sources.raw import read_raw_csv
            report = jobs.run_transform(read_raw_csv(spark, a.input), a.output, salt,
                                        validate=not a.skip_validation,
                                        strict_types=a.strict_types)
            print(report)
        elif a.cmd == "load":
            ts = a.batch_ts or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
            print(jobs.run_load(spark, jobs.read_staged(spark, a.input), a.warehouse, ts))
        elif a.cmd == "query":
            result = analytics.QUERIES[a.name](jobs.read_warehouse(spark, a.warehouse))
            if a.output:
                result.write.mode("overwrite").parquet(a.output)
            else:
                result.show(a.limit, False)
        elif a.cmd == "sql":
            from .plans.sqlviews import register_views, run_script
            register_views(jobs.read_warehouse(spark, a.warehouse))
            text = spark.sparkContext.wholeTextFiles(a.script).values().first()
            for n, df in enumerate(run_script(spark, text), start=1):
                if a.output:
                    df.write.mode("overwrite").parquet(f"{a.output.rstrip('/')}/n={n}")
                else:
                    df.show(a.limit, False)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
