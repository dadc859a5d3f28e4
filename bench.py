"""Time the headline queries: one JSON line on standard output.

Each query is built and run to the end once to warm up and then BENCH_RUNS times (default 2);
the best time counts.  Results go to Spark's ``noop`` sink, which reads every row and column.
"""

from __future__ import annotations

import json
import os
import time

from check_sql import session
from portcheck.queries import QUERIES

HEADLINE = (
    "yard_moves_enriched yard_throughput moves_view join_validity_left join_validity_two_roles "
    "conform_stage summary_load land_slice slice_diff_symmetric scd1_apply scd2_apply scd2_split "
    "fact_surrogate_lookup fact_groupby_multi global_row_id run_log_latest sink_overwrite_partitions "
    "snapshot_read_branch"
).split()


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        run(spark, sf_dir, name)
        times[name] = round(min(run(spark, sf_dir, name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, total of best times", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }), flush=True)


if __name__ == "__main__":
    main()
