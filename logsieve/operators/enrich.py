"""Derived columns and the optional service repartition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.functions import error_flag, slow_flag, status_class
from logsieve.schema import SLOW_MS


def enrich(df: DataFrame, slow_ms: int = SLOW_MS) -> DataFrame:
    """Add date, hour, is_error, is_slow and status_class in one projection."""
    return df.withColumns(
        {
            "date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "is_error": error_flag("status_code"),
            "is_slow": slow_flag("response_time_ms", slow_ms),
            "status_class": status_class("status_code"),
        }
    )


def repartition_by_service(df: DataFrame, n_partitions: int = 200, salt_buckets: int = 1) -> DataFrame:
    """Hash-repartition on service.

    With `salt_buckets > 1` each service is spread over that many partitions
    (salt = hash of the row's time and source), so one heavy service does not
    land in a single task. Not used by the pipeline: grouping already shuffles
    on its own keys after map-side partial aggregation, which moves far less.
    """
    if salt_buckets <= 1:
        return df.repartition(n_partitions, "service")
    salt = F.pmod(F.xxhash64("timestamp", "ip_address", "endpoint"), F.lit(salt_buckets))
    return df.repartition(n_partitions, F.col("service"), salt)
