"""


Every query starts from the access-log rows that `logsieve.sources.events`
derives from the whole `events` table (the same mapping is written in DuckDB
below), drops invalid rows, adds the derived columns and runs one operator.
Window structs are flattened to window_start / window_end for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.operators import (
    aggregate_by_hour,
    aggregate_by_service,
    aggregate_status_distribution,
    build_anomaly_report,
    compute_rolling_error_rate,
    detect_broken_clocks,
    detect_brute_force,
    detect_error_spikes,
    detect_high_latency,
    detect_incidents,
    detect_null_user_ids,
    detect_slow_attacks,
    drop_invalid,
    enrich,
    ip_traffic_summary,
    quality_report,
    read_moments,
    score_latency,
    top_slow_endpoints,
    update_moments,
)
from logsieve.plans import load_logs, run_anomaly_detection, run_pipeline, run_processing
from logsieve.plans.pipeline import ANOMALY_TABLES, PROCESSING_TABLES
from logsieve.schema import LOG_COLUMNS, TIMESTAMP_FORMAT
from logsieve.operators import repartition_by_service
from logsieve.sources import (
    logs_from_events,
    read_days,
    read_logs,
    read_routed,
    replace_days,
    scratch_path,
    write_clustered,
    write_days,
    write_logs_csv,
    write_routed,
)
from logsieve.streaming import prepare_stream, read_log_stream, start_detectors, stream_slow_attacks

# The training-data operators are optional: without their subpackage, or a
# library that only they need, the rest still imports and runs. A module of
# our own that is missing otherwise is an error.
try:
    import corpus_pipeline  # noqa: F401
    from logsieve.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name.startswith("logsieve") and not missing.name.startswith("logsieve.llm"):
        raise
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
STREAM_WATERMARK = "10 minutes"
#: Pipeline tables whose contents are checked after a run from CSV.
PIPELINE_CONTENTS = (
    "by_service", "by_hour", "status_dist", "slow_endpoints", "ip_summary", "error_spikes", "brute_force", "null_users",
)


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(drop_invalid(_logs(spark, sf_dir)))


def _flat_window(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "window"]
    i = df.columns.index("window")
    flat = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return df.select(*[F.col(c) for c in cols[:i]], *flat, *[F.col(c) for c in cols[i:]])


def _csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-ingest")
    write_logs_csv(_logs(spark, sf_dir), path)
    return load_logs(spark, path, view_name=None, cache=False, ntz=True)


STREAM_SLICES = 3


def _time_slices(logs: DataFrame, n: int) -> list[DataFrame]:
    """The logs cut into n slices of equal length, in time order."""
    low, high = logs.agg(F.min("timestamp"), F.max("timestamp")).first()
    if low is None:
        return [logs]
    step = (high - low) / n
    cuts = [low + step * k for k in range(1, n)]
    slices = [logs.where(F.col("timestamp").isNull() | (F.col("timestamp") < F.lit(cuts[0])))]
    slices += [logs.where((F.col("timestamp") >= F.lit(x)) & (F.col("timestamp") < F.lit(y))) for x, y in zip(cuts, cuts[1:])]
    return [*slices, logs.where(F.col("timestamp") >= F.lit(cuts[-1]))]


def _streamed(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """Replay the logs as CSV files through the streaming detectors and read
    back what `table` emitted: the windows its watermark has closed.

    The files arrive in time order, a slice at a time, and the detectors are
    started again for each: every start resumes from the one before, with
    its state and watermark."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src, out = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
        for k, part in enumerate(_time_slices(_logs(spark, sf_dir), STREAM_SLICES)):
            write_logs_csv(part, f"{src}/slice{k}")
            stream = prepare_stream(read_log_stream(spark, f"{src}/*"), STREAM_WATERMARK)
            query = start_detectors(spark, stream, out, available_now=True, tables=(table,))[table]
            query.awaitTermination()
            if query.exception() is not None:
                raise RuntimeError(str(query.exception()))
        return _wall_clock(_flat_window(spark.read.parquet(f"{out}/{table}.parquet")))

    return run


def _wall_clock(df: DataFrame) -> DataFrame:
    """Wall-clock values, as in the queries that read `events` directly."""
    instants = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def _pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "pipeline")
    result = run_pipeline(spark, _logs(spark, sf_dir).drop("event_id"), out)
    counts = [
        spark.read.parquet(result.paths[name]).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        for name in (*PROCESSING_TABLES, *ANOMALY_TABLES)
    ]
    df = counts[0]
    for c in counts[1:]:
        df = df.unionByName(c)
    return df


def _pipeline_table(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """The reference's own path: CSV files -> pipeline -> Parquet, and one of
    its nine tables read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = scratch_path(spark, "pipeline-src")
        write_logs_csv(_logs(spark, sf_dir), src)
        result = run_pipeline(spark, src, scratch_path(spark, "pipeline-out"), ordered_report=False, keep_staged=False)
        df = _wall_clock(spark.read.parquet(result.paths[table]))
        return _wall_clock(_flat_window(df)) if "window" in df.columns else df

    return run


def _cached_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV -> load_logs with its cache and named view -> SQL on the view."""
    src = scratch_path(spark, "view-src")
    write_logs_csv(_logs(spark, sf_dir), src)
    load_logs(spark, src, view_name="cached_logs", ntz=True)
    return spark.sql(
        "select service, http_method, count(*) as requests, sum(bytes_sent) as bytes_sent"
        " from cached_logs group by service, http_method"
    )


def _stream_slow_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs replayed in time order, with a restart after each slice: the
    sessions that the watermark has closed."""
    src, out = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    for k, part in enumerate(_time_slices(_logs(spark, sf_dir), STREAM_SLICES)):
        write_logs_csv(part, f"{src}/slice{k}")
        stream = prepare_stream(read_log_stream(spark, f"{src}/*"), STREAM_WATERMARK)
        writer = stream_slow_attacks(stream).writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", f"{out}/slow_attacks.parquet").option("checkpointLocation", f"{out}/checkpoint")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return _wall_clock(spark.read.parquet(f"{out}/slow_attacks.parquet"))


def _broken_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some machines of the fixture restart in 1970, others are ten years ahead."""
    moved = F.expr(
        "case when event_id % 211 = 7 then timestamp - interval 19723 days"
        " when event_id % 223 = 9 then timestamp + interval 3650 days else timestamp end"
    )
    return detect_broken_clocks(enrich(drop_invalid(_logs(spark, sf_dir).withColumn("timestamp", moved))))


def _replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days written without their byte counts, one of them replaced by its
    true rows, and the days from that one on read back."""
    clean, path, day = _clean(spark, sf_dir), scratch_path(spark, "days"), date(2024, 1, 2)
    write_days(clean.withColumn("bytes_sent", F.lit(0).cast("long")), path)
    replace_days(clean, path, [day])
    return read_days(spark, path, first=day)


def _clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    write_clustered(_clean(spark, sf_dir), path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.read.parquet(path).where(
        "service = 'order-svc' and timestamp >= timestamp_ntz'2024-01-02 03:00:00' and timestamp < timestamp_ntz'2024-01-02 05:00:00'"
    )


def _mangled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs as CSV lines, some cut short, too long, or with a status or a
    time that cannot be read."""
    def line(**other: str) -> F.Column:
        return F.concat_ws(",", *[
            F.lit(other[c]) if c in other
            else F.coalesce(F.date_format(c, TIMESTAMP_FORMAT) if c == "timestamp" else F.col(c).cast("string"), F.lit(""))
            for c in LOG_COLUMNS
        ])

    text = F.when(F.expr("event_id % 89 = 1"), F.substring_index(line(), ",", 7))
    text = text.when(F.expr("event_id % 97 = 2"), F.concat(line(), F.lit(",extra")))
    text = text.when(F.expr("event_id % 101 = 3"), line(status_code="n/a"))
    text = text.when(F.expr("event_id % 103 = 4"), line(timestamp="31/12/2023"))
    text = text.when(F.expr("event_id % 107 = 5"), F.substring_index(line(), ",", 3))
    return _logs(spark, sf_dir).select(text.otherwise(line()).alias("value"))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with broken lines -> one routed write -> both routes read back."""
    src, out = scratch_path(spark, "mangled"), scratch_path(spark, "routed")
    _mangled_lines(spark, sf_dir).write.mode("overwrite").option("header", "false").text(src)
    write_routed(read_routed(spark, src, ntz=True, header=False), out)
    rows = spark.read.parquet(out)
    return rows.select("route", "raw", "reason_mask", F.array_join("reasons", ";").alias("reasons"), "timestamp", "service", "status_code")


def _latency_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments added day by day, one day twice, and every row scored by them."""
    clean, path = _clean(spark, sf_dir), scratch_path(spark, "moments")
    for days in ("date <= date'2024-01-01'", "date = date'2024-01-02'", "date = date'2024-01-02'", "date > date'2024-01-02'"):
        update_moments(clean.where(days), path)
    scored = score_latency(clean, read_moments(spark, path))
    return scored.select("event_id", "service", "response_time_ms", F.round("latency_z", 6).alias("latency_z"))


def _path_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs in three folders, read by a glob and by a list of folders."""
    src = scratch_path(spark, "forms")
    for k, part in enumerate(_time_slices(_logs(spark, sf_dir), STREAM_SLICES)):
        write_logs_csv(part, f"{src}/part{k}")
    by_glob = read_logs(spark, f"{src}/part*", ntz=True).withColumn("form", F.lit("glob"))
    by_list = read_logs(spark, [f"{src}/part{k}" for k in range(STREAM_SLICES)], ntz=True).withColumn("form", F.lit("list"))
    return by_glob.unionByName(by_list).groupBy("form", "service", F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("total"), F.sum("bytes_sent").alias("bytes_sent")
    )


def entry(spark: SparkSession) -> DataFrame:
    return aggregate_by_service(_clean(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | (llm_queries.queries() if llm_queries else {})


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "logs_view": _logs,
        "quality_report": lambda s, d: quality_report(_logs(s, d)),
        "clean_enrich": _clean,
        "service_kpis": lambda s, d: aggregate_by_service(_clean(s, d)),
        "hourly_traffic": lambda s, d: aggregate_by_hour(_clean(s, d)),
        "status_distribution": lambda s, d: aggregate_status_distribution(_clean(s, d)),
        "slow_endpoints": lambda s, d: top_slow_endpoints(_clean(s, d)),
        "ip_summary": lambda s, d: ip_traffic_summary(_clean(s, d)),
        "rolling_error_rate": lambda s, d: compute_rolling_error_rate(_clean(s, d)),
        "high_latency": lambda s, d: detect_high_latency(_clean(s, d)).filter("is_high_latency"),
        "error_spikes": lambda s, d: _flat_window(detect_error_spikes(_clean(s, d))),
        "null_users": lambda s, d: detect_null_user_ids(_clean(s, d)),
        "brute_force": lambda s, d: _flat_window(detect_brute_force(_clean(s, d))),
        "anomaly_report": lambda s, d: build_anomaly_report(_clean(s, d)),
        "csv_ingest": _csv_ingest,
        "salted_service_kpis": lambda s, d: aggregate_by_service(
            repartition_by_service(_clean(s, d), 16, salt_buckets=4)
        ),
        "stream_error_spikes": _streamed("error_spikes"),
        "stream_brute_force": _streamed("brute_force"),
        "pipeline_report": _pipeline_report,
        **{f"pipeline_{name}": _pipeline_table(name) for name in PIPELINE_CONTENTS},
        "pipeline_anomalies": _pipeline_table("report"),
        "cached_view": _cached_view,
        "run_processing": lambda s, d: run_processing(drop_invalid(_logs(s, d)))["by_hour"],
        "run_anomaly_detection": lambda s, d: run_anomaly_detection(drop_invalid(_logs(s, d)))["report"],
        "service_kpis_approx": lambda s, d: aggregate_by_service(_clean(s, d), percentiles="approx"),
        "path_forms": _path_forms,
        "slow_attacks": lambda s, d: detect_slow_attacks(_clean(s, d)),
        "stream_slow_attacks": _stream_slow_attacks,
        "broken_clocks": _broken_clocks,
        "replaced_days": _replaced_days,
        "clustered_lookup": _clustered_lookup,
        "quarantine": _quarantine,
        "latency_scores": _latency_scores,
        "error_incidents": lambda s, d: detect_incidents(_clean(s, d)),
    }


# ---------------------------------------------------------------------------
# DuckDB oracle. `logs` is the fixture mapping in DuckDB syntax, `clean` the
# validated and enriched rows; each query is written against them.

_DAY = "86400 * (case when event_id % 5000 between 300 and 499 then 0 else event_id % 3 end)"
_TS = (
    "timestamp '2024-01-01' + to_seconds(cast(floor((epoch_us(ts)-1704067200000000)/60000000.0)"
    f" + {_DAY} as bigint))"
)
_K = "cast(json_extract(props,'$.k') as int)"

_LOGS = f"""
select event_id, {_TS} as timestamp,
 case when status_code>=500 then 'ERROR' when status_code>=400 then 'WARNING' else 'INFO' end as log_level,
 case when event_id % 997 = 0 then null when user_id % 5 = 0 then 'auth-api' when user_id % 5 = 1 then 'product-svc'
      when user_id % 5 = 2 then 'order-svc' when user_id % 5 = 3 then 'payment-svc' else 'search-svc' end as service,
 case when k < 60 then 'GET' when k < 85 then 'POST' else 'DELETE' end as http_method,
 concat('/api/', event_type) as endpoint,
 status_code,
 cast(floor(value*20) as int) as response_time_ms,
 cast(200 + k*37 as bigint) as bytes_sent,
 case when k = 0 then null else user_id end as user_id,
 case when burst then '192.168.1.1' else concat('10.0.0.', user_id) end as ip_address,
 case when k % 2 = 0 then 'curl/7.85.0' else 'Mozilla/5.0' end as user_agent,
 case when burst then 'REPEATED_FAILURES' when k = 0 then 'NULL_USER_ID' else 'NONE' end as anomaly_type
from (select *, cast(case when event_id % 983 = 2 then null when burst then 401
        when event_type='error' and k < 45 then 500 + k % 5 when event_type='error' then 404
        when event_type='signup' and k < 10 then 301 else 200 end as int) as status_code
      from (select *, {_K} as k, event_id % 5000 between 300 and 499 as burst from events) a) b
"""

_CLEAN = """
select *,
 cast(timestamp as date) as date,
 cast(hour(timestamp) as int) as hour,
 status_code >= 500 as is_error,
 response_time_ms > 2000 as is_slow,
 case when status_code < 300 then '2xx' when status_code < 400 then '3xx'
      when status_code < 500 then '4xx' else '5xx' end as status_class
from logs
where timestamp is not null and log_level is not null and service is not null and status_code is not null
"""

_HIGH_LATENCY = """
select c.*, c.response_time_ms > s.m + 3.0 * s.sd as is_high_latency
from clean c join (select service, avg(response_time_ms) as m, stddev_samp(response_time_ms) as sd
                   from clean group by service) s on c.service = s.service
"""

_ERROR_SPIKES = """
select *, error_rate_pct >= 10 as is_error_spike
from (select service, window_start, window_start + interval 5 minute as window_end, total, errors,
             round(errors / total * 100, 2) as error_rate_pct
      from (select service, time_bucket(interval 5 minute, timestamp) as window_start,
                   count(*)::bigint as total, sum(is_error::int)::bigint as errors
            from clean group by all) g) r
where error_rate_pct >= 10
"""

_BRUTE_FORCE = """
select ip_address, window_start, window_start + interval 5 minute as window_end, total, auth_failures,
       ((2000 * auth_failures + total) // (2 * total)) / 1000.0 as fail_rate, 'BRUTE_FORCE' as anomaly_type
from (select ip_address, time_bucket(interval 5 minute, timestamp) as window_start, count(*)::bigint as total,
             sum(case when status_code in (401, 403) then 1 else 0 end)::bigint as auth_failures
      from clean group by all) g
where total >= 50 and ((2000 * auth_failures + total) // (2 * total)) / 1000.0 >= 0.8
"""

_REPORT = """
select timestamp, service, endpoint, ip_address, status_code, response_time_ms, anomaly_flags, anomaly_count
from (select *,
        concat_ws(',', case when is_error then 'ERROR' else '' end,
                       case when is_high_latency then 'HIGH_LATENCY' else '' end,
                       case when is_slow then 'SLOW' else '' end,
                       case when user_id is null then 'NULL_USER_ID' else '' end) as anomaly_flags,
        (coalesce(is_error, false)::int + coalesce(is_high_latency, false)::int
         + coalesce(is_slow, false)::int + (user_id is null)::int) as anomaly_count
      from high_latency) f
where anomaly_count > 0
"""

_SERVICE_KPIS = """
select service, date, count(*)::bigint as total_requests, sum(is_error::int)::bigint as error_count,
       round(sum(is_error::int) / count(*) * 100, 2) as error_rate_pct,
       quantile_disc(response_time_ms, 0.5) as p50_ms, quantile_disc(response_time_ms, 0.95) as p95_ms,
       quantile_disc(response_time_ms, 0.99) as p99_ms, sum(bytes_sent)::bigint as total_bytes_sent
from clean group by service, date
"""

_SLOW_ENDPOINTS = """
select endpoint, service, avg(response_time_ms) as avg_ms, quantile_disc(response_time_ms, 0.99) as p99_ms,
       count(*)::bigint as calls
from clean group by endpoint, service
order by avg_ms desc nulls last, endpoint asc nulls first, service asc nulls first limit 10
"""

_IP_SUMMARY = """
select ip_address, count(*)::bigint as total_requests, sum(is_error::int)::bigint as errors,
       count(distinct user_id)::bigint as unique_users,
       round(sum(is_error::int) / count(*) * 100, 2) as error_rate_pct
from clean group by ip_address
order by total_requests desc, ip_address asc nulls first limit 20
"""

_BODIES = {
    "logs_view": "select * from logs",
    "quality_report": """
select total_rows, timestamp_nulls, log_level_nulls, service_nulls, status_code_nulls,
       timestamp_nulls / total_rows * 100 as timestamp_null_pct,
       log_level_nulls / total_rows * 100 as log_level_null_pct,
       service_nulls / total_rows * 100 as service_null_pct,
       status_code_nulls / total_rows * 100 as status_code_null_pct,
       dropped_rows, total_rows - dropped_rows as valid_rows
from (select count(*)::bigint as total_rows,
             sum((timestamp is null)::int)::bigint as timestamp_nulls,
             sum((log_level is null)::int)::bigint as log_level_nulls,
             sum((service is null)::int)::bigint as service_nulls,
             sum((status_code is null)::int)::bigint as status_code_nulls,
             sum((timestamp is null or log_level is null or service is null or status_code is null)::int)::bigint
               as dropped_rows
      from logs) q
""",
    "clean_enrich": "select * from clean",
    "service_kpis": _SERVICE_KPIS,
    "hourly_traffic": """
select date, hour, service, count(*)::bigint as requests, avg(response_time_ms) as avg_response_ms
from clean group by date, hour, service
""",
    "status_distribution": """
select service, date, status_class, count(*)::bigint as "count" from clean group by service, date, status_class
""",
    "slow_endpoints": _SLOW_ENDPOINTS,
    "ip_summary": _IP_SUMMARY,
    "rolling_error_rate": """
select *, round(sum(is_error::int) over w / count(*) over w * 100, 2) as rolling_error_rate
from clean
window w as (partition by service order by cast(floor(epoch(timestamp)) as bigint)
             range between 3600 preceding and current row)
""",
    "high_latency": "select * from high_latency where is_high_latency",
    "error_spikes": _ERROR_SPIKES,
    "null_users": "select * from clean where user_id is null",
    "brute_force": _BRUTE_FORCE,
    "anomaly_report": _REPORT,
    "csv_ingest": f"select {', '.join(LOG_COLUMNS)} from clean",
    "salted_service_kpis": _SERVICE_KPIS,
    "stream_error_spikes": f"""
select * from ({_ERROR_SPIKES}) s
where window_end <= (select max(timestamp) from clean) - interval 10 minute
""",
    "stream_brute_force": f"""
select * from ({_BRUTE_FORCE}) s
where window_end <= (select max(timestamp) from clean) - interval 10 minute
""",
    "pipeline_report": f"""
select 'by_service' as table_name, count(*)::bigint as "rows" from ({_SERVICE_KPIS}) t
union all select 'by_hour', count(*) from (select distinct date, hour, service from clean) t
union all select 'status_dist', count(*) from (select distinct service, date, status_class from clean) t
union all select 'slow_endpoints', count(*) from ({_SLOW_ENDPOINTS}) t
union all select 'ip_summary', count(*) from ({_IP_SUMMARY}) t
union all select 'report', count(*) from ({_REPORT}) t
union all select 'error_spikes', count(*) from ({_ERROR_SPIKES}) t
union all select 'brute_force', count(*) from ({_BRUTE_FORCE}) t
union all select 'null_users', count(*) from clean where user_id is null
""",
}
_CSV_CLEAN = "(select * exclude (event_id) from clean)"
_BODIES |= {
    "pipeline_by_service": _SERVICE_KPIS,
    "pipeline_by_hour": _BODIES["hourly_traffic"],
    "pipeline_status_dist": _BODIES["status_distribution"],
    "pipeline_slow_endpoints": _SLOW_ENDPOINTS,
    "pipeline_ip_summary": _IP_SUMMARY,
    "pipeline_anomalies": _REPORT,
    "pipeline_error_spikes": _ERROR_SPIKES,
    "pipeline_brute_force": _BRUTE_FORCE,
    "pipeline_null_users": f"select * from {_CSV_CLEAN} t where user_id is null",
    "cached_view": """
select service, http_method, count(*)::bigint as requests, sum(bytes_sent)::bigint as bytes_sent
from clean group by service, http_method
""",
    "run_processing": _BODIES["hourly_traffic"],
    "run_anomaly_detection": _REPORT,
    "service_kpis_approx": _SERVICE_KPIS,
}


_SLOW_ATTACKS = """
select ip as ip_address, make_timestamp(session_start * 1000000) as session_start,
       make_timestamp(session_end * 1000000) as session_end, total, auth_failures, longest_run,
       make_timestamp(run_start * 1000000) as run_start, make_timestamp(run_end * 1000000) as run_end
from (select ip, session, min(first) as session_start, max(last) as session_end, sum(n)::bigint as total,
             sum(bad)::bigint as auth_failures, max(bad)::bigint as longest_run,
             arg_max(run_start, (bad, -run_start)) as run_start, arg_max(run_end, (bad, -run_start)) as run_end
      from (select ip, session, chain, min(s) as first, max(s) as last, sum(ok + bad) as n, sum(bad) as bad,
                   min(s) filter (bad > 0) as run_start, max(s) filter (bad > 0) as run_end
            from (select *, sum((ok > 0)::int) over (partition by ip, session order by s) as chain
                  from (select *, sum(apart) over (partition by ip order by s) as session
                        from (select *, coalesce((s - lag(s) over (partition by ip order by s) > 1800)::int, 0) as apart
                              from (select ip_address as ip, cast(floor(epoch(timestamp)) as bigint) as s,
                                           count(*) filter (status_code not in (401, 403)) as ok,
                                           count(*) filter (status_code in (401, 403)) as bad
                                    from clean group by all) a) b) c) d
            group by ip, session, chain) e
      group by ip, session) f
where longest_run >= 20
"""

# the text of every line, its fields, and what is wrong with each
_QUARANTINE = """
select case when timestamp is null or log_level is null or service is null or status_code is null
            then 'quarantine' else 'valid' end as route,
       case when len([x for x in found if x is not null]) > 0 then line end as raw,
       (list_sum([case when found[k] is null then 0 else 1 << (k - 1) end for k in range(1, 12)]))::int as reason_mask,
       array_to_string([x for x in found if x is not null], ';') as reasons, timestamp, service, status_code
from (select line, timestamp, log_level, service, status_code,
             [case when f[1] is null then 'missing timestamp' end, case when log_level is null then 'missing log_level' end,
              case when service is null then 'missing service' end, case when f[6] is null then 'missing status_code' end,
              case when f[1] is not null and timestamp is null then 'unreadable timestamp' end,
              case when f[6] is not null and status_code is null then 'unreadable status_code' end,
              case when f[7] is not null and try_cast(f[7] as int) is null then 'unreadable response_time_ms' end,
              case when f[8] is not null and try_cast(f[8] as bigint) is null then 'unreadable bytes_sent' end,
              case when f[9] is not null and try_cast(f[9] as int) is null then 'unreadable user_id' end,
              case when n < 12 then 'too short' end, case when n > 12 then 'too long' end] as found
      from (select line, f, n, try_strptime(f[1], '%Y-%m-%d %H:%M:%S') as timestamp, f[2] as log_level, f[3] as service,
                   try_cast(f[6] as int) as status_code
            from (select line, [nullif(x, '') for x in string_split(line, ',')] as f,
                         len(string_split(line, ',')) as n
                  from (select case when event_id % 89 = 1 then array_to_string(string_split(text, ',')[1:7], ',')
                                    when event_id % 97 = 2 then text || ',extra'
                                    when event_id % 101 = 3 then array_to_string(string_split(text, ',')[1:5], ',') || ',n/a,'
                                      || array_to_string(string_split(text, ',')[7:], ',')
                                    when event_id % 103 = 4 then '31/12/2023,' || array_to_string(string_split(text, ',')[2:], ',')
                                    when event_id % 107 = 5 then array_to_string(string_split(text, ',')[1:3], ',')
                                    else text end as line
                        from (select event_id, concat_ws(',', coalesce(strftime(timestamp, '%Y-%m-%d %H:%M:%S'), ''),
                                log_level, coalesce(service, ''), http_method, endpoint, coalesce(status_code::varchar, ''),
                                coalesce(response_time_ms::varchar, ''), bytes_sent, coalesce(user_id::varchar, ''),
                                ip_address, user_agent, anomaly_type) as text from logs) a) b) c) d) e
"""

_BODIES |= {
    "slow_attacks": _SLOW_ATTACKS,
    "stream_slow_attacks": f"""
select * from ({_SLOW_ATTACKS}) t
where session_end + interval 1800 second < (select max(timestamp) from clean) - interval 10 minute
""",
    "broken_clocks": """
, moved as (
 select * replace (cast(timestamp as date) as date) from (
  select * replace (case when event_id % 211 = 7 then timestamp - to_days(19723)
                         when event_id % 223 = 9 then timestamp + to_days(3650) else timestamp end as timestamp) from clean) m),
hours as (select cast(floor(epoch(timestamp) / 3600) as bigint) as h, count(*) as n from moved group by all),
middle as (select quantile_disc(cast(floor(epoch(timestamp) / 3600) as bigint), 0.5) as m from moved),
spread as (select quantile_disc(abs(cast(floor(epoch(timestamp) / 3600) as bigint) - m), 0.5) as d from moved, middle),
near as (select h, lag(h) over (order by h) as before, lead(h) over (order by h) as after from hours),
bounds as (
 select arg_max(h, (h - before, h)) filter (before < m - greatest(6.0 * d, 24) and h <= m) as low,
        arg_max(h, (after - h, -h)) filter (after > m + greatest(6.0 * d, 24) and h >= m) as high
 from near, middle, spread)
select moved.* exclude (h), case when h < low then 'before' else 'after' end as broken_bound,
       make_timestamp((case when h < low then low * 3600 else (high + 1) * 3600 - 1 end) * 1000000) as bound
from (select *, cast(floor(epoch(timestamp) / 3600) as bigint) as h from moved) moved, bounds
where h < low or h > high
""",
    "replaced_days": """
select * replace (case when date = date '2024-01-02' then bytes_sent else 0 end as bytes_sent)
from clean where date >= date '2024-01-02'
""",
    "clustered_lookup": """
select * from clean
where service = 'order-svc' and timestamp >= timestamp '2024-01-02 03:00:00' and timestamp < timestamp '2024-01-02 05:00:00'
""",
    "quarantine": _QUARANTINE,
    "latency_scores": """
select event_id, c.service, response_time_ms, round((response_time_ms - m) / nullif(sd, 0), 6) as latency_z
from clean c join (select service, avg(response_time_ms) as m, stddev_samp(response_time_ms) as sd
                   from clean group by service) s on c.service = s.service
""",
    "error_incidents": """
, panes as (select service, cast(floor(epoch(timestamp) / 60) as bigint) as p, count(*) as n, sum(is_error::int) as e
            from clean group by all),
wins as (select service, p - k as w, sum(n) as n, sum(e) as e
         from panes, (select unnest(range(5)) as k) ks group by all),
hits as (select service, w, round(e / n * 100, 2) as rate from wins where e > 0 and round(e / n * 100, 2) >= 10),
covered as (select service, w + k as pane, count(*) filter (k = 0) as windows, max(rate) as peak
            from hits, (select unnest(range(5)) as k) ks group by all),
spans as (select c.*, n, e, pane - row_number() over (partition by service order by pane) as span
          from covered c left join (select service as svc, p, n, e from panes) q on c.service = svc and c.pane = p)
select service, make_timestamp(min(pane) * 60000000) as incident_start, make_timestamp((max(pane) + 1) * 60000000) as incident_end,
       sum(windows)::bigint as windows, sum(n)::bigint as total, sum(e)::bigint as errors,
       round(sum(e) / sum(n) * 100, 2) as error_rate_pct, max(peak) as peak_pct
from spans group by service, span
""",
    "path_forms": """
select form, service, cast(timestamp as date) as date, count(*)::bigint as total, sum(bytes_sent)::bigint as bytes_sent
from (select 'glob' as form, * from logs
      union all
      select 'list', * from logs) t
group by all
""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the pre-registered table views."""
    return core_oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def core_oracle_sql() -> dict[str, str]:
    """DuckDB SQL per access-log query, over the `events` view."""
    prefix = f"with logs as ({_LOGS}), clean as ({_CLEAN}), high_latency as ({_HIGH_LATENCY})\n"
    return {name: prefix + body for name, body in _BODIES.items()}
