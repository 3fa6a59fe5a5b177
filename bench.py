"""Time the headline queries.

Reads ``BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line. Each time is the median of
``BENCH_RUNS`` runs after one warm-up, with the whole result computed and discarded. ``BENCH_ONLY``
names the queries to run instead of all. With ``BENCH_COPIES`` above 1 the rollup and the sync diff
also run over that many disjoint copies of their inputs.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from lakewarden import inputs, queries
from lakewarden.operators import inventory as inv
from lakewarden.operators import sync
from lakewarden.session import build_session

HEADLINE = [
    "csv_declared_roundtrip",
    "csv_inferred",
    "ingest_many_files",
    "ingest_rerun",
    "copy_dataset",
    "binary_scan",
    "path_parse",
    "dir_size_all",
    "level_stats",
    "empty_folders",
    "exists_probe",
    "sync_creations",
    "sync_deletions",
    "sync_diff",
    "sync_plan",
    "attempt_outcomes",
    "run_counters",
    "register_roundtrip",
]


def run(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measure(build, runs: int) -> float:
    run(build)
    return round(statistics.median(run(build) for _ in range(runs)), 4)


def copies_of(df, column: str, copies: int):
    """Disjoint copies: each puts its own first path component, or name ending, on every row."""
    number = F.col("copy").cast("string")
    if column == "path":
        renamed = F.concat(F.lit("copy"), number, F.lit("/"), column)
    else:
        renamed = F.concat(column, F.lit("_"), number)
    # The small input is one partition; spread it before it is multiplied.
    spread = df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    numbered = spread.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    return numbered.withColumn(column, renamed).drop("copy")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    only = os.environ.get("BENCH_ONLY")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    spark = build_session(
        "lakewarden-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    # Only the JSON line goes to standard output.
    with contextlib.redirect_stdout(sys.stderr):
        start = time.perf_counter()
        inputs.landed_sales(spark, sf_dir)
        setup = round(time.perf_counter() - start, 4)
        for name in only.split(",") if only else HEADLINE:
            times[name] = measure(lambda name=name: queries.QUERIES[name](spark, sf_dir), runs)
        if copies > 1:
            listing = copies_of(inputs.inventory(spark, sf_dir), "path", copies)
            config = inputs.config(spark, sf_dir)
            tables = sync.compose_targets(inputs.catalog(spark, sf_dir), config)
            sources = copies_of(tables, "target", copies)
            targets = copies_of(inputs.targets(spark, sf_dir), "target", copies)
            targets = sync.owned_targets(targets, config)
            times[f"dir_size_all_x{copies}"] = measure(lambda: inv.directory_sizes(listing, "MB"), 1)
            times[f"empty_folders_x{copies}"] = measure(lambda: inv.mark_empty_folders(listing), 1)
            times[f"sync_diff_x{copies}"] = measure(lambda: sync.diff(sources, targets), 1)
    spark.stop()
    total = round(sum(times.values()), 4)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "setup": setup,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
