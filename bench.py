"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spillway.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "normalise_logs", "wire_entry", "redact_text", "redact_nested", "redact_json", "pack_count", "pack_bytes",
    "pack_age_push", "pack_chunked", "batch_summary", "ingest_body", "gcra_shape", "gcra_police", "window_audit",
    "backoff_drain", "next_action", "rejection_resolve", "deadletter_parse", "drain_report", "repack_schedule",
    "failed_counts", "effective_config",
]


def spread(spark: SparkSession, sf_dir: str, parts: int) -> str:
    """The same tables as folders of ``parts`` files: the given ones are single files that can't be split."""
    out = tempfile.mkdtemp(prefix="bench-")
    for name in sorted(os.listdir(sf_dir)):
        table = spark.read.parquet(os.path.join(sf_dir, name))
        (table.repartition(parts) if os.path.getsize(os.path.join(sf_dir, name)) > 100_000 else table.coalesce(1)).write.parquet(os.path.join(out, name))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    label = os.path.basename(sf_dir.rstrip("/"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    sf_dir = spread(spark, sf_dir, spark.sparkContext.defaultParallelism)
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": label}))


if __name__ == "__main__":
    main()
