"""Column expressions shared by the operators (all built-in Spark functions)."""

from logsieve.functions.columns import (
    epoch_seconds,
    error_flag,
    flag_token,
    pct,
    slow_flag,
    status_class,
)

__all__ = [
    "epoch_seconds",
    "error_flag",
    "flag_token",
    "pct",
    "slow_flag",
    "status_class",
]
