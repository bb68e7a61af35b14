"""Slow attacks: the longest run of failed requests in each session of an IP.

A tumbling window sees an attack only if it is fast. Here the rows of an IP
are cut into sessions wherever more than `gap_seconds` pass without a row, and
each session is searched for its longest run of failures without a success in
between, however slowly they come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from logsieve.functions import epoch_seconds
from logsieve.schema import AUTH_FAILURE_CODES, SESSION_GAP_SECONDS, SLOW_ATTACK_MIN_RUN

#: Seconds of an IP that are put in order together.
BUCKET_SECONDS = 3600

SESSION_COLUMNS = (
    "ip_address", "session_start", "session_end", "total", "auth_failures", "longest_run", "run_start", "run_end",
)


def is_failure(codes: Sequence[int] = AUTH_FAILURE_CODES) -> Column:
    """A null status is no failure."""
    return F.coalesce(F.col("status_code").isin(*codes), F.lit(False))


def instant(seconds: Column, dtype: DataType) -> Column:
    """The timestamp of whole seconds since 1970, of the kind `dtype`."""
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.timestamp_seconds(seconds)


def session_runs(df: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, codes: Sequence[int] = AUTH_FAILURE_CODES) -> DataFrame:
    """Sessions by IP (a null IP is one of its own) with their longest run.

    Times are whole seconds. Rows of one second count as its successes and
    then its failures, so a second with both ends one run and begins another.
    Of equally long runs the earliest is given; without a failure longest_run
    is 0 and run_start, run_end are null. Rows without a timestamp are in no
    session.

    No task holds the rows of an IP. They are first counted by second, which
    combines map-side. Seconds are put in order within (IP, hour): at most
    3,600. What goes on from there is at most three pieces for every stretch
    of activity in an hour: its first and last run, which may go on in the
    hours beside it, and the longest of the others. Putting an IP's pieces in
    order is bounded by the time the log covers, not by its rows.
    """
    kind = df.schema["timestamp"].dataType
    failed = is_failure(codes).cast("long")
    seconds = df.where(F.col("timestamp").isNotNull()).groupBy(
        F.col("ip_address").alias("ip"), epoch_seconds("timestamp", kind).alias("s")
    ).agg((F.count(F.lit(1)) - F.sum(failed)).alias("ok"), F.sum(failed).alias("failures"))
    seconds = seconds.withColumn("hour", F.floor(F.col("s") / BUCKET_SECONDS))

    # stretches of an hour without a gap, and the runs inside; a second with a
    # success begins a run
    inside = Window.partitionBy("ip", "hour").orderBy("s")
    apart = F.coalesce(F.col("s") - F.lag("s").over(inside) > gap_seconds, F.lit(False))
    seconds = seconds.withColumn("apart", apart.cast("int")).withColumns({
        "stretch": F.sum("apart").over(inside), "run": F.sum((F.col("ok") > 0).cast("int")).over(inside),
    })
    pieces = seconds.groupBy("ip", "hour", "stretch", "run").agg(
        F.sum("failures").alias("length"), F.sum("ok").alias("ok"),
        F.min("s").alias("first"), F.max("s").alias("last"),
        F.min(F.when(F.col("failures") > 0, F.col("s"))).alias("run_start"),
        F.max(F.when(F.col("failures") > 0, F.col("s"))).alias("run_end"),
    )
    whole = Window.partitionBy("ip", "hour", "stretch")
    pieces = pieces.withColumns({
        "stretch_first": F.min("first").over(whole), "stretch_last": F.max("last").over(whole),
        "stretch_ok": F.sum("ok").over(whole), "stretch_failures": F.sum("length").over(whole),
        "from_front": F.row_number().over(whole.orderBy("run")), "from_back": F.row_number().over(whole.orderBy(F.desc("run"))),
    })
    ends = (F.col("from_front") == 1) | (F.col("from_back") == 1)
    best = F.row_number().over(whole.orderBy(ends, F.desc("length"), "run"))
    pieces = pieces.withColumn("best", best).where(ends | (F.col("best") == 1))

    # the same over all that is left of an IP
    along = Window.partitionBy("ip").orderBy("stretch_first", "run")
    apart = F.coalesce((F.col("stretch_first") - F.lag("stretch_last").over(along) > gap_seconds), F.lit(False))
    pieces = pieces.withColumn("apart", apart.cast("int"))
    pieces = pieces.withColumns({
        "session": F.sum("apart").over(along), "chain": F.sum((F.col("ok") > 0).cast("int")).over(along),
    })
    front = F.col("from_front") == 1
    runs = pieces.groupBy("ip", "session", "chain").agg(
        F.sum("length").alias("length"), F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"),
        F.min("stretch_first").alias("first"), F.max("stretch_last").alias("last"),
        F.sum(F.when(front, F.col("stretch_ok") + F.col("stretch_failures")).otherwise(0)).alias("total"),
        F.sum(F.when(front, F.col("stretch_failures")).otherwise(0)).alias("auth_failures"),
    )
    longest = F.struct("length", (-F.col("run_start")).alias("early"), "run_end")
    sessions = runs.groupBy("ip", "session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("total").alias("total"),
        F.sum("auth_failures").alias("auth_failures"), F.max(F.when(F.col("length") > 0, longest)).alias("longest"),
    )
    return sessions.select(
        F.col("ip").alias("ip_address"), instant(F.col("first"), kind).alias("session_start"),
        instant(F.col("last"), kind).alias("session_end"), "total", "auth_failures",
        F.coalesce("longest.length", F.lit(0)).alias("longest_run"),
        instant(-F.col("longest.early"), kind).alias("run_start"), instant(F.col("longest.run_end"), kind).alias("run_end"),
    )


def detect_slow_attacks(
    df: DataFrame, min_run: int = SLOW_ATTACK_MIN_RUN, gap_seconds: int = SESSION_GAP_SECONDS,
    codes: Sequence[int] = AUTH_FAILURE_CODES, ordered: bool = True,
) -> DataFrame:
    """Sessions whose longest run of failures has at least `min_run` rows."""
    out = session_runs(df, gap_seconds, codes).where(F.col("longest_run") >= min_run)
    return out.orderBy(F.desc("longest_run"), "session_start", "ip_address") if ordered else out
