"""Time the headline queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query runs once to warm
up and then ``$BENCH_RUNS`` times; the median is reported.  Results go to the
``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidepair.plans.queries import REGISTRY  # noqa: E402
from tidepair.session import build_session  # noqa: E402

HEADLINE = (
    "clean_series",
    "clean_series_relational",
    "cosine_aligned",
    "cosine_aligned_broadcast",
    "cosine_vectors",
    "cosine_shared_days",
    "cosine_shared_days_broadcast",
    "top20_mean",
    "top20_min",
    "top20_max",
    "match_report",
    "sketch_similarity_threshold",
    "sketch_similarity_windows",
    "stream_cells",
    "stream_similarity",
    "stream_progress",
)


def timed(query, spark, sf_dir: str) -> float:
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "tidepair-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "7g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        query = REGISTRY[name]
        timed(query, spark, sf_dir)
        times = [timed(query, spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    if "stream_similarity" in seconds:
        rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        line["stream_rows_per_sec"] = round(rows / seconds["stream_similarity"])
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
