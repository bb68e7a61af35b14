"""End-to-end batch pipeline: load -> validate -> enrich -> 9 tables -> Parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from logsieve.operators import (
    aggregate_by_hour,
    aggregate_by_service,
    aggregate_status_distribution,
    build_anomaly_report,
    cache_logs,
    detect_brute_force,
    detect_error_spikes,
    detect_null_user_ids,
    enrich,
    ip_traffic_summary,
    quality_report,
    top_slow_endpoints,
    validate_logs,
)
from logsieve.schema import MANDATORY_COLUMNS, Thresholds
from logsieve.sources import read_logs, remove_path, save_results, scratch_path

PROCESSING_TABLES = ("by_service", "by_hour", "status_dist", "slow_endpoints", "ip_summary")
ANOMALY_TABLES = ("report", "error_spikes", "brute_force", "null_users")


def load_logs(
    spark: SparkSession,
    path: str | list[str],
    *,
    view_name: str | None = "logs",
    cache: bool = True,
    observation: Observation | None = None,
    **read_options,
) -> DataFrame:
    """Read CSV logs, drop invalid rows and (optionally) cache + register them."""
    df = validate_logs(read_logs(spark, path, **read_options), MANDATORY_COLUMNS, observation)
    return cache_logs(df, view_name) if cache else df


def run_processing(df: DataFrame, thresholds: Thresholds = Thresholds(), *, enriched: bool = False) -> dict[str, DataFrame]:
    """The five KPI tables (lazy)."""
    if not enriched:
        df = enrich(df, thresholds.slow_ms)
    return {name: build() for name, build in processing_tables(df, thresholds).items()}


def processing_tables(df: DataFrame, thresholds: Thresholds = Thresholds()) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the five KPI tables over enriched rows. Building a
    DataFrame already costs driver time (each step is analysed), so a writer
    builds its table in its own thread, in parallel with the others."""
    return {
        "by_service": lambda: aggregate_by_service(df),
        "by_hour": lambda: aggregate_by_hour(df),
        "status_dist": lambda: aggregate_status_distribution(df),
        "slow_endpoints": lambda: top_slow_endpoints(df, thresholds.top_slow_endpoints),
        "ip_summary": lambda: ip_traffic_summary(df, thresholds.top_ips),
    }


def run_anomaly_detection(
    df: DataFrame, thresholds: Thresholds = Thresholds(), *, enriched: bool = False, ordered_report: bool = True
) -> dict[str, DataFrame]:
    """The four anomaly tables. Only the report's latency check runs a job
    now (the broadcast size check); the rest stay lazy."""
    if not enriched:
        df = enrich(df, thresholds.slow_ms)
    return {name: build() for name, build in anomaly_tables(df, thresholds, ordered_report).items()}


def anomaly_tables(
    df: DataFrame, thresholds: Thresholds = Thresholds(), ordered_report: bool = True
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the four anomaly tables over enriched rows, so a writer
    can construct each (and run the report's size check) in its own thread."""
    return {
        "report": lambda: build_anomaly_report(df, thresholds.latency_multiplier, ordered=ordered_report),
        "error_spikes": lambda: detect_error_spikes(df, thresholds.error_spike_pct, thresholds.window),
        "brute_force": lambda: detect_brute_force(
            df,
            thresholds.brute_force_min_requests,
            thresholds.brute_force_fail_rate,
            thresholds.window,
            thresholds.auth_failure_codes,
        ),
        "null_users": lambda: detect_null_user_ids(df),
    }


@dataclass
class PipelineResult:
    paths: dict[str, str]
    quality: dict[str, int] = field(default_factory=dict)
    staged_at: str | None = None


def run_pipeline(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    output_dir: str,
    thresholds: Thresholds = Thresholds(),
    *,
    stage: str = "table",
    max_parallel_jobs: int | None = None,
    partition_by: dict[str, list[str]] | None = None,
    stage_dir: str | None = None,
    keep_staged: bool = True,
    ordered_report: bool = True,
) -> PipelineResult:
    """Run everything and write the nine tables to `{output_dir}/{name}.parquet`.

    `source` is a CSV path (or list) or an already-parsed log DataFrame.
    The cleaned, enriched rows are produced once and then read by all tables:
      - stage="table" (default): written as Parquet under the session's
        checkpoint folder. This cuts the lineage, so a lost executor costs a
        re-read of columnar files, not a re-parse of CSV, and each result
        reads only the columns it needs.
      - stage="cache": persisted in executor memory/disk.
      - stage="none": every table re-reads the source.
    The quality numbers are observed during that single first pass; with
    stage="none" they are a pass of their own.
    `stage_dir` puts the staged table somewhere of the caller's choosing
    (overwritten), e.g. to keep it as the cleaned log table;
    `keep_staged=False` removes it when the tables are written.
    `ordered_report=False` leaves out the report's global sort, which is the
    largest shuffle of the pipeline.
    `partition_by` names output partition columns per table, e.g.
    {"null_users": ["date"]} for date-pruned reads later.
    """
    obs = Observation("quality")
    raw = read_logs(spark, source) if not isinstance(source, DataFrame) else source
    clean = enrich(validate_logs(raw, MANDATORY_COLUMNS, obs), thresholds.slow_ms)

    staged_at = None
    if stage == "table":
        staged_at = stage_dir or scratch_path(spark, "staged-logs")
        clean.write.mode("overwrite").parquet(staged_at)
        clean = spark.read.parquet(staged_at)
    elif stage == "cache":
        clean = clean.persist()
        clean.count()
    elif stage != "none":
        raise ValueError(f"unknown stage {stage!r}")

    # The report has the longest chain (statistics, size check, join, sort),
    # so it is submitted first.
    results = {
        **anomaly_tables(clean, thresholds, ordered_report),
        **processing_tables(clean, thresholds),
    }
    paths = save_results(results, output_dir, partition_by=partition_by, max_parallel_jobs=max_parallel_jobs)
    if stage == "none":
        numbers = quality_report(raw).first().asDict()
        quality = {k: v for k, v in numbers.items() if not k.endswith("_pct") and k != "valid_rows"}
    else:
        quality = dict(obs.get)
    if stage == "cache":
        clean.unpersist()
    if staged_at and not keep_staged:
        remove_path(spark, staged_at)
        staged_at = None
    return PipelineResult(paths=paths, quality=quality, staged_at=staged_at)
