"""Latency scores from moments that add up over days.

For each service and day the state holds n, the mean and M2, the sum of
squared deviations from it. States of disjoint rows merge exactly as if all
rows had been seen at once, so a new day costs one pass over that day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.operators.joins import attach_small

STATE_COLUMNS = ("service", "date", "n", "mean", "m2")


def latency_moments(df: DataFrame) -> DataFrame:
    """(service, date, n, mean, m2) of the rows that have a latency."""
    x = F.col("response_time_ms").cast("double")
    rows = df.where(F.col("response_time_ms").isNotNull()).groupBy("service", "date")
    return rows.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"))


def merge_moments(states: DataFrame, *keys: str) -> DataFrame:
    """One state for each value of `keys`, from any states of disjoint rows.

    The mean is the weighted mean of the means; M2 adds up, and each state
    adds n times its squared distance from the common mean. Means are taken
    first and joined back, so no difference of large sums is formed.
    """
    mean = states.groupBy(*keys).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}_"))
    mean = mean.withColumnsRenamed({k: f"_{k}_" for k in keys})
    off = F.col("mean") - F.col("_mean")
    merged = states.join(mean, same).groupBy(*keys).agg(
        F.first("_n").alias("n"), F.first("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2")
    )
    return merged


def update_moments(df: DataFrame, path: str) -> None:
    """Put the moments of the days in `df` into the state table at `path`,
    a folder for each day, in place of what it held of those days.

    Running a day again replaces it, so a restarted or corrected day is never
    counted twice; other days are not touched.
    """
    state = latency_moments(df)
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*STATE_COLUMNS)


def score_latency(df: DataFrame, states: DataFrame) -> DataFrame:
    """`df` with `latency_z`: how many sample standard deviations a row's
    latency lies above the mean of its service, over all rows in `states`.

    Null for a null latency, for a service of which fewer than two rows were
    seen, and for one whose latencies were all equal. The merged states, one
    for each service, are joined null-safe, broadcast if their measured size
    allows.
    """
    merged = merge_moments(states, "service").select(
        F.col("service").alias("_svc"), F.col("mean").alias("_mean"), F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1)).alias("_std")
    )
    joined = attach_small(df, merged, F.col("service").eqNullSafe(F.col("_svc")))
    score = F.try_divide(F.col("response_time_ms") - F.col("_mean"), F.col("_std"))
    return joined.withColumn("latency_z", score).drop("_svc", "_mean", "_std")
