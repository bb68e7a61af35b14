"""Skew probe: the pipeline and the rolling rate on logs where one service and
one IP each hold a third of all rows.

usage: python tools/skew_probe.py [rows]

Generates the rows with Spark into the scratch folder (not a registered
query: made-up data, used only to watch task balance and timing), runs
`run_pipeline`, `compute_rolling_error_rate` and `detect_high_latency`. Set spark.eventLog.* to inspect task
times per stage.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from logsieve.operators import compute_rolling_error_rate, detect_high_latency, drop_invalid, enrich  # noqa: E402
from logsieve.plans import run_pipeline  # noqa: E402
from logsieve.sources import scratch_path  # noqa: E402


def skewed_logs(spark: SparkSession, n: int):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n, numPartitions=32).select(
        F.timestamp_seconds(F.lit(1704067200) + (i * 7919) % (86400 * 3)).alias("timestamp"),
        F.when(i % 50 == 0, "ERROR").otherwise("INFO").alias("log_level"),
        F.when(hot, "auth-api").otherwise(F.concat(F.lit("svc-"), (i % 40).cast("string"))).alias("service"),
        F.lit("GET").alias("http_method"),
        F.concat(F.lit("/api/item/"), (i % 100_000).cast("string")).alias("endpoint"),
        F.when(i % 50 == 0, 500).when(hot & (i % 7 == 0), 401).otherwise(200).cast("int").alias("status_code"),
        ((i * 13) % 5000).cast("int").alias("response_time_ms"),
        ((i * 17) % 10000).cast("bigint").alias("bytes_sent"),
        F.when(i % 97 == 0, None).otherwise(i % 200_000).cast("bigint").alias("user_id"),
        F.when(i % 3 == 1, "6.6.6.6")
        .otherwise(F.concat(F.lit("10.1."), (i % 250).cast("string"), F.lit("."), (i % 199).cast("string")))
        .alias("ip_address"),
        F.lit("Mozilla/5.0").alias("user_agent"),
        F.lit("NONE").alias("anomaly_type"),
    )


def _time(label: str, run) -> None:
    t0 = time.perf_counter()
    run()
    print(f"{label}: {time.perf_counter() - t0:.1f} s", flush=True)


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    spark = SparkSession.builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    src = scratch_path(spark, "skew-src")
    skewed_logs(spark, n).write.parquet(src)
    logs = spark.read.parquet(src)
    clean = enrich(drop_invalid(logs))
    _time("pipeline", lambda: run_pipeline(spark, logs, scratch_path(spark, "skew-out")))
    _time("rolling (running sums)", lambda: compute_rolling_error_rate(clean).write.format("noop").mode("overwrite").save())
    _time("high latency", lambda: detect_high_latency(clean).write.format("noop").mode("overwrite").save())


if __name__ == "__main__":
    main()
