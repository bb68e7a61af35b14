"""Log schema, mandatory columns and detector thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values: these must equal the reference's for results to match. ---
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
MANDATORY_COLUMNS = ("timestamp", "log_level", "service", "status_code")
SLOW_MS = 2000
LATENCY_MULTIPLIER = 3.0
ERROR_SPIKE_PCT = 10
BRUTE_FORCE_MIN_REQUESTS = 50
BRUTE_FORCE_FAIL_RATE = 0.8
AUTH_FAILURE_CODES = (401, 403)
WINDOW_DURATION = "5 minutes"
ROLLING_LOOKBACK_SECONDS = 3600
TOP_SLOW_ENDPOINTS = 10
TOP_IPS = 20

# Column layout of the CSV access log, in file order. `timestamp` is read as
# text and parsed afterwards so a bad value becomes null instead of failing.
LOG_SCHEMA = StructType(
    [
        StructField("timestamp", StringType()),
        StructField("log_level", StringType()),
        StructField("service", StringType()),
        StructField("http_method", StringType()),
        StructField("endpoint", StringType()),
        StructField("status_code", IntegerType()),
        StructField("response_time_ms", IntegerType()),
        StructField("bytes_sent", LongType()),
        StructField("user_id", LongType()),
        StructField("ip_address", StringType()),
        StructField("user_agent", StringType()),
        StructField("anomaly_type", StringType()),
    ]
)

# Columns of the row-level anomaly report.
REPORT_COLUMNS = (
    "timestamp",
    "service",
    "endpoint",
    "ip_address",
    "status_code",
    "response_time_ms",
    "anomaly_flags",
    "anomaly_count",
)
# --- end of fixed values ---

CORRUPT_RECORD_COLUMN = "_corrupt_record"

# Bounds of the detectors that go beyond the fixed tumbling windows.
SESSION_GAP_SECONDS = 1800
SLOW_ATTACK_MIN_RUN = 20
CLOCK_REACH_MADS = 6.0
CLOCK_MIN_REACH_HOURS = 24
INCIDENT_MIN_TOTAL = 1

LOG_COLUMNS = tuple(f.name for f in LOG_SCHEMA.fields)
DERIVED_COLUMNS = ("date", "hour", "is_error", "is_slow", "status_class")


@dataclass(frozen=True)
class Thresholds:
    """All tunables of the detectors in one place."""

    slow_ms: int = SLOW_MS
    latency_multiplier: float = LATENCY_MULTIPLIER
    error_spike_pct: float = ERROR_SPIKE_PCT
    brute_force_min_requests: int = BRUTE_FORCE_MIN_REQUESTS
    brute_force_fail_rate: float = BRUTE_FORCE_FAIL_RATE
    auth_failure_codes: tuple[int, ...] = AUTH_FAILURE_CODES
    window: str = WINDOW_DURATION
    rolling_lookback_seconds: int = ROLLING_LOOKBACK_SECONDS
    top_slow_endpoints: int = TOP_SLOW_ENDPOINTS
    top_ips: int = TOP_IPS
    session_gap_seconds: int = SESSION_GAP_SECONDS
    slow_attack_min_run: int = SLOW_ATTACK_MIN_RUN
