"""Readers and writers: CSV access logs, quarantine, the events-derived log
fixture, Parquet result sinks, days and clustered tables, the scratch folder."""

from logsieve.sources.clustered import write_clustered
from logsieve.sources.csv_logs import read_logs, write_logs_csv
from logsieve.sources.days import read_days, replace_days, write_days
from logsieve.sources.events import logs_from_events
from logsieve.sources.parquet import read_results, save_results
from logsieve.sources.quarantine import read_quarantine, read_routed, read_valid, write_routed
from logsieve.sources.scratch import checkpoint_root, remove_path, scratch_path

__all__ = [
    "checkpoint_root",
    "logs_from_events",
    "read_days",
    "read_logs",
    "read_quarantine",
    "read_results",
    "read_routed",
    "read_valid",
    "remove_path",
    "replace_days",
    "save_results",
    "scratch_path",
    "write_clustered",
    "write_days",
    "write_logs_csv",
    "write_routed",
]
