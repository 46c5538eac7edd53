"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query is computed in full into a no-op sink. The given tables are one file with one row group each,
which only one core can read. So they are also written as one file per core, before the clock starts:
``value`` and ``queries`` are times on those, ``as_given`` those on the tables as they are.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES
from millrace.session import build_session

WARM_DIR = "/root/testdata/sf0.001"
HEADLINE = (
    "quality_report", "pii_redacted", "exact_dedup", "near_dedup_kept", "curation_outcomes", "split_rows", "leakage",
    "golden_by_category", "gate", "request_validity", "outcome", "input_screen", "quota_decisions", "cache_hits",
    "knn_topk", "latency_quantile", "rate_5m", "alerts", "drift_decision", "stream_window_counts",
)


TABLES = ("events", "documents", "embeddings", "benchmark", "labels", "conversations")


def in_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The tables the queries read, each in ``files`` files."""
    out = tempfile.mkdtemp(prefix="millrace-bench-")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{out}/{name}.parquet")
    return out


def timed(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "millrace-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:  # code is loaded and compiled before the clock starts, whatever comes first
        QUERIES[name](spark, WARM_DIR).write.format("noop").mode("overwrite").save()

    times = timed(spark, in_files(spark, sf_dir, int(cpus)))
    given = timed(spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "as_given": {"value": round(sum(given.values()), 3), "queries": given},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
