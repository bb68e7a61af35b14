"""Compositions of the operators: ingestion, processing, detection and the
end-to-end batch pipeline."""

from logsieve.plans.pipeline import (
    PROCESSING_TABLES,
    ANOMALY_TABLES,
    load_logs,
    run_anomaly_detection,
    run_pipeline,
    run_processing,
)

__all__ = [
    "ANOMALY_TABLES",
    "PROCESSING_TABLES",
    "load_logs",
    "run_anomaly_detection",
    "run_pipeline",
    "run_processing",
]
