"""The cleaned log as one Parquet folder for each day, which can be replaced
and read on its own."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.sources.scratch import remove_path


def write_days(df: DataFrame, path: str) -> None:
    """Write rows (with a `date` column) under `{path}/date=YYYY-MM-DD`.

    Days that `df` has rows of are replaced as a whole; the folders of all
    others stay as they are, file by file (dynamic partition overwrite: new
    files are moved in only when the job has succeeded, so a lost executor or
    a failed run leaves the old day). A row without a date goes to a folder of
    its own. Writing the same day again gives the same table.

    Rows are rebalanced by day: a day is written by few tasks, in files of the
    advisory partition size, and a day that holds most rows is split.
    """
    rows = df.hint("rebalance", F.col("date"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def replace_days(df: DataFrame, path: str, days: Sequence[date]) -> None:
    """Make `df`'s rows of `days` the whole content of those days, and leave
    all others alone. A day that `df` has no row of becomes empty."""
    spark, wanted = df.sparkSession, sorted(set(days))
    if not wanted:
        return
    rows = df.where(F.col("date").isin(wanted))
    write_days(rows, path)
    present = {r[0] for r in rows.select("date").distinct().collect()}  # at most one for each of `days`
    for day in wanted:
        if day not in present:
            remove_path(spark, f"{path.rstrip('/')}/date={day.isoformat()}")


def read_days(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows of the days from `first` to `last` (inclusive; None: open).

    The bounds are filters on the partition column: other days' folders are
    not listed into the scan, let alone read.
    """
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("date") >= F.lit(first))
    if last is not None:
        df = df.where(F.col("date") <= F.lit(last))
    return df
