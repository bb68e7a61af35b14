"""Exact percentiles of an integer column per group, from value histograms.

`percentile_approx` ships one sketch per group from every map task, and one
reducer per group merges them all: with few groups (services x days) and
many tasks, that is a hot spot. An integer latency has few distinct values,
so a histogram is both exact and cheap:
  1. count rows per (group, value): combined map-side, spread over reducers
     by value;
  2. per group, running counts over the sorted values - a window partition
     holds one row per distinct value, not one per input row;
  3. the p-th percentile is the smallest value whose running count reaches
     rank ceil(p * n) over the n non-null values. That is the value
     `percentile_approx` returns whenever its sketch is exact, and what it
     approximates otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALUE = "_pv"
COUNT = "_pc"


def value_histogram(df: DataFrame, keys: Sequence[str], value: str, *sums: Column) -> DataFrame:
    """Rows per (keys, value), plus any extra per-bucket aggregates (e.g.
    sums that the caller rolls up to the group). Null values keep a bucket."""
    return df.groupBy(*keys, F.col(value).alias(VALUE)).agg(F.count(F.lit(1)).alias(COUNT), *sums)


def percentile_columns(histogram: DataFrame, keys: Sequence[str], targets: Mapping[str, float]) -> tuple[DataFrame, list[Column]]:
    """Add running counts to a histogram; return it and the aggregate
    expressions that pick each percentile when grouped by `keys`."""
    nonnull = F.when(F.col(VALUE).isNotNull(), F.col(COUNT)).otherwise(F.lit(0))
    part = Window.partitionBy(*keys)
    running = part.orderBy(VALUE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.select("*", F.sum(nonnull).over(running).alias("_cum"), F.sum(nonnull).over(part).alias("_n"))
    picks = []
    for name, p in targets.items():
        rank = F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1))
        reached = F.col(VALUE).isNotNull() & (F.col("_cum") >= rank)
        picks.append(F.min(F.when(reached, F.col(VALUE))).alias(name))
    return ranked, picks


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, targets: Mapping[str, float]) -> DataFrame:
    """One row per group of `keys` with a column per target percentile."""
    ranked, picks = percentile_columns(value_histogram(df, keys, value), keys, targets)
    return ranked.groupBy(*keys).agg(*picks)
