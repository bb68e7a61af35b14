"""Lazy DataFrame -> DataFrame operators."""

from logsieve.operators.anomalies import (
    build_anomaly_report,
    detect_brute_force,
    detect_error_spikes,
    detect_high_latency,
    detect_null_user_ids,
    flag_rows,
    latency_stats,
)
from logsieve.operators.clocks import (
    ClockBounds,
    clock_bounds,
    detect_broken_clocks,
    hour_histogram,
    merge_histograms,
)
from logsieve.operators.enrich import enrich, repartition_by_service
from logsieve.operators.incidents import detect_incidents, error_panes, spike_windows
from logsieve.operators.metrics import (
    aggregate_by_hour,
    aggregate_by_service,
    aggregate_status_distribution,
    ip_traffic_summary,
    top_slow_endpoints,
)
from logsieve.operators.moments import latency_moments, merge_moments, read_moments, score_latency, update_moments
from logsieve.operators.quality import (
    cache_dataframe,
    cache_logs,
    drop_invalid,
    quality_report,
    validate_logs,
    validate_schema,
)
from logsieve.operators.percentiles import exact_percentiles
from logsieve.operators.rolling import compute_rolling_error_rate, rolling_error_rates
from logsieve.operators.sessions import detect_slow_attacks, session_runs

__all__ = [
    "ClockBounds",
    "aggregate_by_hour",
    "aggregate_by_service",
    "aggregate_status_distribution",
    "build_anomaly_report",
    "cache_dataframe",
    "cache_logs",
    "clock_bounds",
    "compute_rolling_error_rate",
    "detect_broken_clocks",
    "detect_brute_force",
    "detect_error_spikes",
    "detect_high_latency",
    "detect_incidents",
    "detect_null_user_ids",
    "detect_slow_attacks",
    "drop_invalid",
    "enrich",
    "error_panes",
    "exact_percentiles",
    "flag_rows",
    "hour_histogram",
    "ip_traffic_summary",
    "latency_moments",
    "latency_stats",
    "merge_histograms",
    "merge_moments",
    "quality_report",
    "read_moments",
    "repartition_by_service",
    "rolling_error_rates",
    "score_latency",
    "session_runs",
    "spike_windows",
    "top_slow_endpoints",
    "update_moments",
    "validate_logs",
    "validate_schema",
]
