"""Rolling one-hour error rate per service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from logsieve.functions import epoch_seconds, pct
from logsieve.schema import ROLLING_LOOKBACK_SECONDS


def rolling_error_rates(df: DataFrame, lookback_seconds: int = ROLLING_LOOKBACK_SECONDS) -> DataFrame:
    """(_svc, _sec, rolling_error_rate): error % (rounded to 2) of a service
    over [t - lookback, t] in whole seconds, both ends included, all rows of
    the same second included, for each second in which it has a row.

    This is the small table behind `compute_rolling_error_rate`; read it
    directly where the rate need not be on every row. It costs O(n log n) and
    never puts a whole service in one task:
      1. pre-aggregate rows to (service, second): requests, errors;
      2. cut time into buckets of `lookback` seconds. A second's totals go to
         its own bucket and, as a copy, to the next one, so every frame a
         second needs lies inside its own bucket's partition (at most
         2 * lookback seconds of one service);
      3. per (service, bucket), running sums C(t) over seconds give the frame
         total as C(s) - C(s - lookback - 1). The second term is read from a
         zero-weight probe row placed at s - lookback - 1, then brought next
         to its second by a re-sort within the same partitioning.
    Running sums are used because Spark's sliding RANGE frame re-aggregates
    the frame whenever its lower bound moves, i.e. O(rows x frame).
    """
    sec = epoch_seconds("timestamp", df.schema["timestamp"].dataType)
    err = F.col("is_error").cast("int")
    width = max(lookback_seconds, 1)
    per_second = df.groupBy(F.col("service").alias("_svc"), sec.alias("_sec")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(err).alias("_e"),
        F.count(err).alias("_k"),  # seconds whose error flags are all null add no errors
    )

    # (bucket shift, is probe): own-bucket source, next-bucket copy, probe.
    variants = F.when(
        F.col("_sec").isNull(), F.array(F.struct(F.lit(0).alias("shift"), F.lit(False).alias("probe")))
    ).otherwise(
        F.array(
            F.struct(F.lit(0).alias("shift"), F.lit(False).alias("probe")),
            F.struct(F.lit(1).alias("shift"), F.lit(False).alias("probe")),
            F.struct(F.lit(0).alias("shift"), F.lit(True).alias("probe")),
        )
    )
    v = per_second.select("*", F.explode(variants).alias("_v"))
    probe = F.col("_v.probe")
    rows = v.select(
        "_svc",
        (F.floor(F.col("_sec") / width) + F.col("_v.shift")).alias("_bucket"),
        # Position on the time line: a probe sits just before its frame.
        F.when(probe, F.col("_sec") - lookback_seconds - 1).otherwise(F.col("_sec")).alias("_pos"),
        "_sec",
        probe.alias("_probe"),
        (F.col("_v.shift") == 0).alias("_own"),
        *[F.when(probe, F.lit(0)).otherwise(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("_n", "_e", "_k")],
    )

    part = Window.partitionBy("_svc", "_bucket")
    # Sources before probes at equal position: C(t) counts seconds <= t.
    running = part.orderBy("_pos", "_probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = rows.select(
        "_svc",
        "_bucket",
        "_sec",
        "_probe",
        "_own",
        *[F.sum(c).over(running).alias(c) for c in ("_n", "_e", "_k")],
    ).filter(F.col("_own"))

    # Each second is directly followed by its probe; subtract the probe's sums.
    pair = part.orderBy("_sec", "_probe")
    frame = {c: F.col(c) - F.coalesce(F.lead(c).over(pair), F.lit(0)) for c in ("_n", "_e", "_k")}
    return cum.select(
        "_svc",
        "_sec",
        "_probe",
        pct(F.when(frame["_k"] > 0, frame["_e"]), frame["_n"]).alias("rolling_error_rate"),
    ).filter(~F.col("_probe")).drop("_probe")


def compute_rolling_error_rate(df: DataFrame, lookback_seconds: int = ROLLING_LOOKBACK_SECONDS) -> DataFrame:
    """Add `rolling_error_rate` of the row's service and second: the rates of
    `rolling_error_rates`, joined back to the rows on (service, second)."""
    rates = rolling_error_rates(df, lookback_seconds)
    sec = epoch_seconds("timestamp", df.schema["timestamp"].dataType)
    cond = F.col("service").eqNullSafe(F.col("_svc")) & sec.eqNullSafe(F.col("_sec"))
    return df.join(rates, cond, "left").drop("_svc", "_sec")
