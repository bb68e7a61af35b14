"""Error incidents: spikes in sliding windows, merged into one time span each.

A spike that a tumbling window cuts in two may stay below the bound in both
halves. Here the window slides by one pane (a minute), and all windows above
the bound that touch or overlap make one incident.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsieve.functions import epoch_seconds, pct
from logsieve.operators.sessions import instant
from logsieve.schema import ERROR_SPIKE_PCT, INCIDENT_MIN_TOTAL


def error_panes(df: DataFrame, pane_seconds: int = 60) -> DataFrame:
    """(service, pane, total, errors): counts by pane, an interval of
    `pane_seconds` since 1970. They combine map-side, and panes of parts of the
    data add up. Rows without a timestamp are left out."""
    pane = F.floor(epoch_seconds("timestamp", df.schema["timestamp"].dataType) / pane_seconds)
    rows = df.where(F.col("timestamp").isNotNull()).groupBy("service", pane.alias("pane"))
    return rows.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(F.col("is_error").cast("long")), F.lit(0)).alias("errors"))


def spike_windows(panes: DataFrame, width: int = 5, threshold_pct: float = ERROR_SPIKE_PCT, min_total: int = INCIDENT_MIN_TOTAL) -> DataFrame:
    """(service, pane, total, errors, error_rate_pct): windows of `width` panes,
    beginning with `pane`, of at least `min_total` rows whose rounded error
    percentage is `threshold_pct` or more. Every pane adds its counts to the
    `width` windows it is in; only panes are multiplied, never rows."""
    starts = F.explode(F.sequence(F.col("pane") - (width - 1), F.col("pane")))
    windows = panes.select("service", starts.alias("pane"), "total", "errors").groupBy("service", "pane")
    windows = windows.agg(F.sum("total").alias("total"), F.sum("errors").alias("errors"))
    windows = windows.withColumn("error_rate_pct", pct(F.col("errors"), F.col("total")))
    return windows.where((F.col("error_rate_pct") >= threshold_pct) & (F.col("errors") > 0) & (F.col("total") >= min_total))


def detect_incidents(
    df: DataFrame, width: int = 5, pane_seconds: int = 60, threshold_pct: float = ERROR_SPIKE_PCT,
    min_total: int = INCIDENT_MIN_TOTAL, ordered: bool = True,
) -> DataFrame:
    """(service, incident_start, incident_end, windows, total, errors,
    error_rate_pct, peak_pct): maximal spans covered by spike windows.

    total and errors count the rows of the span once; peak_pct is the largest
    rate of its windows. A null service is one of its own. An empty input
    gives no incident.

    Rows are only counted by pane. Spans are found among the panes that some
    spike covers, which are bounded by the time the log covers.
    """
    kind = df.schema["timestamp"].dataType
    panes = error_panes(df, pane_seconds)
    hits = spike_windows(panes, width, threshold_pct, min_total)
    inside = F.explode(F.sequence(F.col("pane"), F.col("pane") + (width - 1)))
    covered = hits.select("service", inside.alias("at"), "pane", "error_rate_pct").groupBy("service", "at").agg(
        F.count_if(F.col("at") == F.col("pane")).alias("windows"), F.max("error_rate_pct").alias("peak_pct")
    )
    counts = panes.select(F.col("service").alias("_svc"), "pane", "total", "errors")
    covered = covered.join(counts, F.col("service").eqNullSafe(F.col("_svc")) & (F.col("at") == F.col("pane")), "left")
    place = F.row_number().over(Window.partitionBy("service").orderBy("at"))
    spans = covered.withColumn("span", F.col("at") - place).groupBy("service", "span").agg(
        F.min("at").alias("first"), (F.max("at") + 1).alias("end"), F.sum("windows").alias("windows"),
        F.sum("total").alias("total"), F.sum("errors").alias("errors"), F.max("peak_pct").alias("peak_pct"),
    )
    out = spans.select(
        "service", instant(F.col("first") * pane_seconds, kind).alias("incident_start"),
        instant(F.col("end") * pane_seconds, kind).alias("incident_end"), "windows", "total", "errors",
        pct(F.col("errors"), F.col("total")).alias("error_rate_pct"), "peak_pct",
    )
    return out.orderBy(F.desc("peak_pct"), "incident_start", "service") if ordered else out
