"""Times the headline queries: one warm-up, then the median of three runs, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sluice.queries import ALL
from sluice.session import build_session

HEADLINE = [
    "enrichment_job",
    "json_object_scan",
    "json_split_scan",
    "line_json",
    "binary_scan",
    "route_by_extension",
    "multi_input_union",
    "stage_chain",
    "batch_module",
    "merged_json",
    "group_key",
    "group_key_untyped",
    "grouped_module",
    "grouped_frames",
    "grouped_combiner",
    "grouped_salted",
    "post_group",
    "ordered_groups",
    "routed_emit",
    "archived_raw",
    "drop_folder",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    ALL[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
