"""Wall seconds of the headline queries; prints one JSON line."""

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = ["q_latency_distribution", "q_hit_rate", "q_pooled_cohorts", "q_cost_per_job", "q_batch_unit_cost", "q_request_latency",
            "q_scd2_observed", "q_scd2_changelog", "q_asof_join", "q_state_events", "q_daily_rollup", "q_log_fields", "q_segment_measures",
            "q_redact", "q_snapshot_select", "q_priority_dedup", "q_gap_buckets", "q_table_parity"]


def seconds(spark, query, sf_dir: str, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return statistics.median(times[1:])       # the first run warms up


def main() -> int:
    from tephra.plans import registry
    from tephra.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench")
    queries = registry.queries()
    took = {n: round(seconds(spark, queries[n], sf_dir, runs), 3) for n in names}
    small = os.environ.get("BENCH_SMALL_DIR")                     # with a tenth of the rows, say: shows what grows faster than its input
    ratio = {n: round(took[n] / max(1e-3, seconds(spark, queries[n], small, runs)), 2) for n in names} if small else None
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
                      "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(os.environ.get("BENCH_CPUS", "8")), "runs": runs} | ({"ratio": ratio} if ratio else {})))
    return 0


if __name__ == "__main__":
    sys.exit(main())
