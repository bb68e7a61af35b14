"""Data-quality report, invalid-row removal and caching (ingestion steps)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logsieve.schema import MANDATORY_COLUMNS


def _null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _any_null(columns: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return cond


def quality_report(df: DataFrame, columns: Sequence[str] = MANDATORY_COLUMNS) -> DataFrame:
    """One-row summary in a single pass: total rows, nulls and null % per
    mandatory column, rows dropped by `drop_invalid` and rows kept. Without
    input rows every count is 0 and every percentage null."""
    total = F.count(F.lit(1))
    nulls = [_null_count(c).alias(f"{c}_nulls") for c in columns]
    dropped = F.count_if(_any_null(columns))
    agg = df.agg(total.alias("total_rows"), *nulls, dropped.alias("dropped_rows"))
    return agg.select(
        "total_rows",
        *[F.col(f"{c}_nulls") for c in columns],
        *[(F.try_divide(f"{c}_nulls", "total_rows") * 100).alias(f"{c}_null_pct") for c in columns],
        "dropped_rows",
        (F.col("total_rows") - F.col("dropped_rows")).alias("valid_rows"),
    )


def drop_invalid(df: DataFrame, columns: Sequence[str] = MANDATORY_COLUMNS) -> DataFrame:
    """Drop rows with a null in any mandatory column.

    Same rows as `dropna(subset=columns)`, but written as a conjunction of
    IS NOT NULL tests: `dropna` plans as one AtLeastNNonNulls expression the
    scan cannot take, while each IS NOT NULL on a source column is pushed into
    the CSV/Parquet reader.
    """
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def validate_logs(
    df: DataFrame,
    columns: Sequence[str] = MANDATORY_COLUMNS,
    observation: Observation | None = None,
) -> DataFrame:
    """`drop_invalid`, optionally collecting the quality numbers as a side
    effect of whatever job later consumes the rows (no extra scan)."""
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("total_rows"),
            *[_null_count(c).alias(f"{c}_nulls") for c in columns],
            F.count_if(_any_null(columns)).alias("dropped_rows"),
        )
    return drop_invalid(df, columns)


def cache_logs(df: DataFrame, name: str | None = "logs") -> DataFrame:
    """Persist (memory, spilling to disk) and register a temp view.

    Cached blocks lost with an executor are recomputed from lineage."""
    df = df.persist()
    if name:
        df.createOrReplaceTempView(name)
    return df


# Names used by the reference's API, for drop-in use.
validate_schema = drop_invalid
cache_dataframe = cache_logs
