"""Reusable column expressions.

Everything here is a plain `pyspark.sql.functions` expression, so it stays
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

_EPOCH_NTZ_TEXT = "1970-01-01 00:00:00"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def error_flag(status: str | Column = "status_code") -> Column:
    """5xx or above is an error; a null status gives null."""
    return _col(status) >= 500


def slow_flag(latency: str | Column = "response_time_ms", slow_ms: int = 2000) -> Column:
    """Strictly slower than `slow_ms`; a null latency gives null."""
    return _col(latency) > slow_ms


def status_class(status: str | Column = "status_code") -> Column:
    """'2xx' .. '5xx'. Codes below 300 fall in 2xx; null falls through to 5xx."""
    s = _col(status)
    return (
        F.when(s < 300, "2xx")
        .when(s < 400, "3xx")
        .when(s < 500, "4xx")
        .otherwise("5xx")
    )


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole * 100 rounded half-up to `digits` places."""
    return F.round(part / whole * 100, digits)


def epoch_seconds(ts: str | Column, dtype: DataType) -> Column:
    """Whole seconds since 1970-01-01 (floored), for TIMESTAMP or TIMESTAMP_NTZ.

    A TIMESTAMP is an instant, so `unix_seconds` applies. A TIMESTAMP_NTZ is a
    wall-clock value; it is measured against the NTZ epoch so the result does
    not depend on the session time zone (no DST shifts).
    """
    c = _col(ts)
    if isinstance(dtype, TimestampNTZType):
        epoch = F.lit(_EPOCH_NTZ_TEXT).cast(TimestampNTZType())
        micros = F.timestamp_diff("MICROSECOND", epoch, c)
        return F.floor(micros / F.lit(1_000_000)).cast("bigint")
    return F.unix_seconds(c)


def flag_token(condition: Column, name: str, keep_empty: bool = True) -> Column:
    """`name` when the condition holds. Otherwise '' (kept as an empty token by
    concat_ws) or null (skipped by concat_ws)."""
    token = F.when(condition, F.lit(name))
    return token.otherwise(F.lit("")) if keep_empty else token
