"""Access-log rows derived from the `events` table.

The test data has no access logs, so a deterministic mapping turns each event
into one log row (service from user, status from event type, latency from
value, a burst of failed logins from one IP, and so on). The mapping is the
shared fixture definition; the SQL oracle applies the same text in DuckDB.
It reads the whole `events` table, so the log grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: the fixture mapping, identical in the oracle. ---
_BURST = "event_id % 5000 between 300 and 499"
_DAY = f"86400 * (case when {_BURST} then 0 else event_id % 3 end)"
_TS = (
    "timestampadd(SECOND, cast(floor(timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)/60)"
    f" + {_DAY} as int), timestamp_ntz'2024-01-01 00:00:00')"
)
_K = "cast(get_json_object(props,'$.k') as int)"

_LOGS_SQL = f"""
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
      from (select *, {_K} as k, {_BURST} as burst from {{events}}) a) b
"""
# --- end of fixed values ---


def logs_from_events(spark: SparkSession, events: DataFrame | str) -> DataFrame:
    """Log rows (event_id + the 12 log columns, timestamp as TIMESTAMP_NTZ).

    `events` is a DataFrame or a folder holding `events.parquet`.
    """
    if isinstance(events, str):
        events = spark.read.parquet(f"{events.rstrip('/')}/events.parquet")
    return spark.sql(_LOGS_SQL, events=events)
