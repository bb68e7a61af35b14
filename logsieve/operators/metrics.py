"""KPI tables: per service and day, per hour, status classes, slow endpoints,
per-IP traffic.

All are hash aggregations; Spark runs a partial aggregate before the shuffle,
so the shuffle carries one small buffer per key and map task however skewed a
key is. Latency percentiles are exact, from value histograms (see
`logsieve.operators.percentiles`); `percentiles="approx"` gives Spark's
`percentile_approx` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions import pct
from logsieve.operators.joins import restrict_to_keys
from logsieve.operators.percentiles import COUNT, VALUE, percentile_columns, value_histogram
from logsieve.schema import TOP_IPS, TOP_SLOW_ENDPOINTS

# Spark's default accuracy for percentile_approx (relative rank error 1/10000).
PERCENTILE_ACCURACY = 10000
SERVICE_PERCENTILES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}


def _errors() -> Column:
    return F.sum(F.col("is_error").cast("int"))


def aggregate_by_service(
    df: DataFrame,
    ordered: bool = True,
    *,
    percentiles: str = "exact",
    accuracy: int = PERCENTILE_ACCURACY,
) -> DataFrame:
    """Per (service, date): volume, errors, error %, p50/p95/p99 latency, bytes.

    `percentiles="exact"` (default) reads everything from one histogram of
    (service, date, latency): counts, errors and bytes are summed per bucket
    and rolled up to the group, and the percentiles are picked from running
    counts. One scan, no per-group sketches. `percentiles="approx"` uses
    `percentile_approx` with `accuracy`.
    """
    keys = ["service", "date"]
    if percentiles == "approx":
        out = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("total_requests"),
            _errors().alias("error_count"),
            pct(_errors(), F.count(F.lit(1))).alias("error_rate_pct"),
            *[F.percentile_approx("response_time_ms", p, accuracy).alias(n) for n, p in SERVICE_PERCENTILES.items()],
            F.sum("bytes_sent").alias("total_bytes_sent"),
        )
    elif percentiles == "exact":
        hist = value_histogram(df, keys, "response_time_ms", _errors().alias("_e"), F.sum("bytes_sent").alias("_b"))
        ranked, picks = percentile_columns(hist, keys, SERVICE_PERCENTILES)
        total, errors = F.sum(COUNT), F.sum("_e")
        out = ranked.groupBy(*keys).agg(
            total.alias("total_requests"),
            errors.alias("error_count"),
            pct(errors, total).alias("error_rate_pct"),
            *picks,
            F.sum("_b").alias("total_bytes_sent"),
        )
    else:
        raise ValueError(f"unknown percentiles {percentiles!r}")
    return out.orderBy("date", "service") if ordered else out


def aggregate_by_hour(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per (date, hour, service): request count and mean latency."""
    out = df.groupBy("date", "hour", "service").agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("response_time_ms").alias("avg_response_ms"),
    )
    return out.orderBy("date", "hour", "service") if ordered else out


def aggregate_status_distribution(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per (service, date, status_class): row count."""
    out = df.groupBy("service", "date", "status_class").agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy("service", "date", "status_class") if ordered else out


def top_slow_endpoints(
    df: DataFrame,
    n: int = TOP_SLOW_ENDPOINTS,
    *,
    percentiles: str = "exact",
    accuracy: int = PERCENTILE_ACCURACY,
) -> DataFrame:
    """The n (endpoint, service) pairs with the highest mean latency, with
    their p99 latency and call count.

    Ties at the cut are broken by endpoint, then service, so the result is
    deterministic. Two steps keep this cheap when endpoints are many (paths
    with ids in them): the mean of every pair, top n by a per-partition top-n
    merge (TakeOrderedAndProject, never a full sort); then mean, p99 and
    calls of those n pairs, all from one histogram of their rows, which a
    semi-join against the hashes of the n keys (broadcast while n is small)
    selects.
    """
    keys = ["endpoint", "service"]
    order = [F.col("avg_ms").desc(), "endpoint", "service"]
    top = df.groupBy(*keys).agg(F.avg("response_time_ms").alias("avg_ms")).orderBy(*order).limit(n)
    rows = restrict_to_keys(df, top, keys, known_rows=n)
    if percentiles == "exact":
        ranked, picks = percentile_columns(value_histogram(rows, keys, "response_time_ms"), keys, {"p99_ms": 0.99})
        # Integer sums divided once: the same double as avg() over the rows.
        timed = F.sum(F.when(F.col(VALUE).isNotNull(), F.col(COUNT)))
        mean = F.sum(F.col(VALUE) * F.col(COUNT)) / timed
        out = ranked.groupBy(*keys).agg(mean.alias("avg_ms"), *picks, F.sum(COUNT).alias("calls"))
    elif percentiles == "approx":
        p99 = F.percentile_approx("response_time_ms", 0.99, accuracy)
        out = rows.groupBy(*keys).agg(
            F.avg("response_time_ms").alias("avg_ms"), p99.alias("p99_ms"), F.count(F.lit(1)).alias("calls")
        )
    else:
        raise ValueError(f"unknown percentiles {percentiles!r}")
    return out.select("endpoint", "service", "avg_ms", "p99_ms", "calls").orderBy(*order).limit(n)


def ip_traffic_summary(df: DataFrame, top_n: int = TOP_IPS, approx_users: bool = False) -> DataFrame:
    """The top_n source IPs by request count, with errors, distinct users and
    error %. Ties are broken by IP.

    The distinct user count is exact by default. Spark plans it in two steps:
    partial aggregation on (ip, user_id), then on ip, so a heavy IP with many
    users still reaches the final shuffle as one row per map task. With
    `approx_users=True` it is a HyperLogLog++ estimate (about 5 % relative
    error): one aggregation step, fixed-size buffers.
    """
    users = F.approx_count_distinct("user_id") if approx_users else F.countDistinct("user_id")
    return (
        df.groupBy("ip_address")
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            _errors().alias("errors"),
            users.alias("unique_users"),
            pct(_errors(), F.count(F.lit(1))).alias("error_rate_pct"),
        )
        .orderBy(F.col("total_requests").desc(), "ip_address")
        .limit(top_n)
    )
