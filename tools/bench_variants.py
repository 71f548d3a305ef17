"""Time plan variants of the job.

    python tools/bench_variants.py [sf_dir] [runs]

* pre-dedupe none / messaging (default) / both, one- and two-sided window;
* the script-shaped SQL, which also dedupes before the explode, and the
  one-statement SQL form of the job;
* the partitioned write with and without ``rebalance``;
* the scheduled run's shape (11-day customer window) with and without the
  runtime bloom filter.

Each variant is warmed up once, then timed ``runs`` times, interleaved; the
median is printed as one JSON line per variant.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 5
    from visitmap import DateWindow, build_visit_map
    from visitmap.operators import (add_build_stamp, add_report_date, distinct_sql, explode_ids,
                                    group_by_all_sql, link, project_contract)
    from visitmap.plans import build_visit_map_sql
    from visitmap.session import local_session, scratch_path
    from visitmap.sinks import overwrite_partitions
    from visitmap.sources import load_inputs, scan_customer, scan_messaging

    spark = local_session(8, shuffle_partitions=16, app="visitmap-variants")
    w = DateWindow("1997-01-01", "1998-12-31")

    def inputs():
        return load_inputs(spark, sf_dir)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    variants = {}
    for sides in ("left", "both"):
        for mode in ("none", "messaging", "both"):
            variants[f"{sides}/prededupe={mode}"] = (
                lambda s=sides, m=mode: noop(build_visit_map(*inputs(), w, sides=s, prededupe=m, build_ts="2024-02-01")))
    def script_shape():
        cus, msg = inputs()
        linked = distinct_sql(spark, link(scan_customer(cus, w), scan_messaging(msg)))
        noop(project_contract(add_build_stamp(add_report_date(group_by_all_sql(spark, explode_ids(linked))),
                                              "2024-02-01")))

    variants["left/sql_script_shape_two_dedupes"] = script_shape
    variants["left/sql_one_statement"] = lambda: noop(build_visit_map_sql(spark, *inputs(), w, build_ts="2024-02-01"))
    report_days = DateWindow("1998-01-01", "1998-03-31", "report_days")
    for rb in (True, False):
        variants[f"write_90_days/rebalance={rb}"] = (
            lambda r=rb: overwrite_partitions(build_visit_map(*inputs(), report_days, build_ts="2024-02-01"),
                                              scratch_path(spark, "variants"), rebalance=r))

    scheduled = DateWindow.rolling("1997-06-12")

    def with_bloom(on):
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true" if on else "false")
        try:
            noop(build_visit_map(*inputs(), scheduled, build_ts="2024-02-01"))
        finally:
            spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")

    for on in (True, False):
        variants[f"scheduled_11_days/bloom_filter={on}"] = lambda o=on: with_bloom(o)

    for fn in variants.values():
        fn()
    samples = {k: [] for k in variants}
    for _ in range(runs):
        for k, fn in variants.items():
            t0 = time.perf_counter()
            fn()
            samples[k].append(time.perf_counter() - t0)
    for k, v in samples.items():
        print(json.dumps({"variant": k, "median_sec": round(statistics.median(v), 3),
                          "min_sec": round(min(v), 3), "sf_dir": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
