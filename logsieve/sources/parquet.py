"""Parquet sink for result tables: one folder per table, overwritten."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def table_path(output_dir: str, name: str) -> str:
    return f"{output_dir.rstrip('/')}/{name}.parquet"


def save_results(
    results: Mapping[str, DataFrame | Callable[[], DataFrame]],
    output_dir: str,
    *,
    partition_by: Mapping[str, list[str]] | None = None,
    max_parallel_jobs: int | None = None,
) -> dict[str, str]:
    """Write each DataFrame to `{output_dir}/{name}.parquet` (overwrite).

    The Spark writer creates the folders, so any Hadoop URI works. Tables are
    submitted as concurrent jobs (all at once unless `max_parallel_jobs` says
    otherwise) so the stages of one table fill the slots another leaves idle;
    `partition_by` names per-table partition columns (e.g. {"null_users": ["date"]}).
    A value may also be a function returning the DataFrame; it is then built
    in its writer thread, so any job its construction runs overlaps the
    other writes.
    """
    partition_by = partition_by or {}
    paths = {name: table_path(output_dir, name) for name in results}

    def write(name: str) -> None:
        df = results[name]
        if callable(df):
            df = df()
        writer = df.write.mode("overwrite")
        if partition_by.get(name):
            writer = writer.partitionBy(*partition_by[name])
        writer.parquet(paths[name])

    spark = SparkSession.getActiveSession()  # thread-local: look it up here

    def run(name: str) -> None:
        # Name this thread's jobs after the table (job lists, event logs).
        if spark is not None:
            spark.sparkContext.setJobDescription(f"write {name}")
        write(name)

    workers = max(1, min(max_parallel_jobs or len(paths), len(paths)))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        # Submitted in the mapping's order: the default FIFO scheduler gives
        # earlier jobs first claim on free task slots.
        for f in [pool.submit(run, n) for n in paths]:
            f.result()
    return paths


def read_results(spark: SparkSession, output_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(table_path(output_dir, n)) for n in names}
