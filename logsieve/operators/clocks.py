"""Broken clocks: rows whose time lies far outside the log's own.

A machine whose clock was reset writes valid timestamps (1970, or years
ahead) that pass every check and make date groups of their own. The bounds
are found from counts by hour alone: median and median absolute deviation tell
which hours are out of reach, and the widest gap before them is where the log
ends and the broken clocks begin.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsieve.functions import epoch_seconds
from logsieve.operators.sessions import instant
from logsieve.schema import CLOCK_MIN_REACH_HOURS, CLOCK_REACH_MADS


@dataclass(frozen=True)
class ClockBounds:
    """First and last hour (since 1970) of the log proper; None: no bound on that side."""

    low: int | None
    high: int | None


def hour_histogram(df: DataFrame) -> DataFrame:
    """(hour, rows): hours since 1970; rows without a timestamp are left out.

    Counts combine map-side, and histograms of parts of the data add up: keep
    one for each day and `merge_histograms` them.
    """
    hour = F.floor(epoch_seconds("timestamp", df.schema["timestamp"].dataType) / 3600)
    rows = df.where(F.col("timestamp").isNotNull()).groupBy(hour.alias("hour"))
    return rows.agg(F.count(F.lit(1)).alias("rows"))


def merge_histograms(*parts: DataFrame) -> DataFrame:
    """The histogram of all rows, from those of its parts."""
    return reduce(DataFrame.unionByName, parts).groupBy("hour").agg(F.sum("rows").alias("rows"))


def _median(hist: DataFrame, value: Column) -> int | None:
    """The lower median of `value`, each hour counted `rows` times."""
    ordered = hist.groupBy(value.alias("v")).agg(F.sum("rows").alias("rows"))
    upto = F.sum("rows").over(Window.orderBy("v"))
    whole = F.sum("rows").over(Window.partitionBy())
    return ordered.select("v", upto.alias("upto"), whole.alias("whole")).where("2 * upto >= whole").agg(F.min("v")).first()[0]


def clock_bounds(hist: DataFrame, reach_mads: float = CLOCK_REACH_MADS, min_reach_hours: int = CLOCK_MIN_REACH_HOURS) -> ClockBounds:
    """Bounds of the log proper, from its hour histogram.

    Hours further from the median than `reach_mads` deviations, and than
    `min_reach_hours`, are out of reach. On a side that has any, the log ends
    at the widest gap between two neighbouring hours of which the outer one is
    out of reach (of gaps equally wide the innermost). So a log's own tail,
    which runs on without such a gap, is not cut off inside.

    A few small jobs run over the histogram, which has one row for each hour
    that occurs; four numbers reach the driver. An empty log has no bounds.
    """
    middle = _median(hist, F.col("hour"))
    if middle is None:
        return ClockBounds(None, None)
    spread = _median(hist, F.abs(F.col("hour") - F.lit(middle)))
    reach = max(reach_mads * spread, min_reach_hours)
    order = Window.orderBy("hour")
    hours = hist.select("hour", F.lag("hour").over(order).alias("before"), F.lead("hour").over(order).alias("after"))
    low = (F.col("before") < middle - reach) & (F.col("hour") <= middle)
    high = (F.col("after") > middle + reach) & (F.col("hour") >= middle)
    edges = hours.agg(
        F.max(F.when(low, F.struct((F.col("hour") - F.col("before")).alias("gap"), F.col("hour").alias("at")))).alias("low"),
        F.max(F.when(high, F.struct((F.col("after") - F.col("hour")).alias("gap"), (-F.col("hour")).alias("at")))).alias("high"),
    ).first()
    return ClockBounds(edges["low"]["at"] if edges["low"] else None, -edges["high"]["at"] if edges["high"] else None)


def detect_broken_clocks(df: DataFrame, bounds: ClockBounds | None = None) -> DataFrame:
    """Rows outside the log's own hours, with `broken_bound` ('before' or
    'after') and `bound`, the first or last instant that would have passed.

    The bounds are found now (by `clock_bounds`, unless given) and become two
    literals, so the search for rows is a filter at the scan: no join, no
    window over rows, however many rows or hours there are.
    """
    if bounds is None:
        bounds = clock_bounds(hour_histogram(df))
    kind = df.schema["timestamp"].dataType
    first = instant(F.lit(bounds.low).cast("long") * 3600, kind)
    last = instant((F.lit(bounds.high).cast("long") + 1) * 3600 - 1, kind)
    before = F.coalesce(F.col("timestamp") < first, F.lit(False))
    after = F.coalesce(F.col("timestamp") >= instant((F.lit(bounds.high).cast("long") + 1) * 3600, kind), F.lit(False))
    return df.where(before | after).withColumns({
        "broken_bound": F.when(before, "before").otherwise("after"), "bound": F.when(before, first).otherwise(last),
    })
