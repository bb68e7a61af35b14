"""Continuous detection over a growing folder of CSV logs.

The batch operators are reused as they are: Spark turns the windowed
aggregations into stateful operators, and the watermark decides when a
(key, window) is final and can be emitted in append mode and its state
dropped. Results are appended to Parquet folders; progress and state live
beside them, so a query started again over the same output resumes where it
stopped. A window is emitted once the watermark has passed its end: the last
windows of a folder that has stopped growing stay open, in the state, and the
batch detectors over that folder give them.

Only detectors whose result for a window is final once the window closes
are streamed. The latency report needs each service's statistics over the
whole input, and the KPI tables are sorted snapshots; both stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from logsieve.operators import detect_brute_force, detect_error_spikes, detect_null_user_ids, drop_invalid, enrich
from logsieve.schema import LOG_SCHEMA, TIMESTAMP_FORMAT, Thresholds
from logsieve.sources.csv_logs import parse_timestamp

STREAM_TABLES = ("error_spikes", "brute_force", "null_users")


def read_log_stream(
    spark: SparkSession,
    path: str,
    *,
    timestamp_format: str = TIMESTAMP_FORMAT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Header CSV files arriving in `path`, with the declared schema.

    Timestamps are TIMESTAMP (an instant): a watermark needs that type.
    """
    reader = spark.readStream.schema(LOG_SCHEMA).option("header", "true").option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(path)
    return df.withColumn("timestamp", parse_timestamp(df["timestamp"], timestamp_format))


def prepare_stream(stream: DataFrame, watermark: str = "10 minutes", slow_ms: int = Thresholds.slow_ms) -> DataFrame:
    """Drop invalid rows, add derived columns and declare how late rows may
    arrive. Rows later than the watermark are not counted.

    A (key, window) row is emitted, final, once window.end <= latest event
    time seen - `watermark`.
    """
    if isinstance(stream.schema["timestamp"].dataType, TimestampNTZType):
        raise TypeError("a watermark needs TIMESTAMP event times; cast TIMESTAMP_NTZ with .cast('timestamp')")
    return enrich(drop_invalid(stream), slow_ms).withWatermark("timestamp", watermark)


def stream_tables(stream: DataFrame, thresholds: Thresholds = Thresholds()) -> dict[str, DataFrame]:
    """The streamable detector tables over a prepared stream (unsorted:
    append mode emits each window once, when the watermark passes it)."""
    return {
        "error_spikes": detect_error_spikes(stream, thresholds.error_spike_pct, thresholds.window, ordered=False),
        "brute_force": detect_brute_force(
            stream,
            thresholds.brute_force_min_requests,
            thresholds.brute_force_fail_rate,
            thresholds.window,
            thresholds.auth_failure_codes,
            ordered=False,
        ),
        "null_users": detect_null_user_ids(stream),
    }


def start_detectors(
    spark: SparkSession,
    stream: DataFrame,
    output_dir: str,
    thresholds: Thresholds = Thresholds(),
    *,
    checkpoint_dir: str | None = None,
    available_now: bool = False,
    processing_time: str = "1 minute",
    tables: tuple[str, ...] = STREAM_TABLES,
) -> dict[str, StreamingQuery]:
    """Start one append-mode query for each of `tables`, writing `{output_dir}/{name}.parquet`.

    `checkpoint_dir` defaults to `{output_dir}/_checkpoints`, which belongs to
    these outputs: starting again over the same output resumes, and every row
    is counted once. A new checkpoint folder over old outputs would restart
    the batch numbers, and the Parquet sink skips numbers it has already
    committed. `available_now=True` processes what is there and stops
    (scheduled batch-style runs).
    """
    ckpt = checkpoint_dir or f"{output_dir.rstrip('/')}/_checkpoints"
    queries = {}
    for name in tables:
        writer = (
            stream_tables(stream, thresholds)[name].writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{output_dir.rstrip('/')}/{name}.parquet")
            .option("checkpointLocation", f"{ckpt}/{name}")
            .queryName(f"logsieve_{name}")
        )
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
        queries[name] = writer.start()
    return queries


def late_rows(query: StreamingQuery) -> int:
    """Aggregated rows that a query dropped for being behind the watermark, in
    the progress reports that Spark still keeps of it."""
    return sum(
        int(operator["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
