"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE). Each query is executed in full
with the ``noop`` sink (nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["item_item_cf", "item_item_cf_bt", "eval_report", "threshold_sweep", "slope_one", "user_knn", "co_cluster_full",
            "switch_blend", "mf_predict", "gbt_profiles", "hybrid_stack"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    from sparkrec.plans.catalog import run
    from sparkrec.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="sparkrec-bench")
    times, rows = {}, {}
    for name in names:
        t0 = time.time()
        df = run(spark, name, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "spark": spark.version}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
