"""Helpers shared by the operators: staged tables and column name clashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsieve.sources import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, never a
    recomputation of what made them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` less the columns called like one of `names` in any letter case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def each(column: pa.Array) -> Iterator:
    """The values of an Arrow column one by one: a batch of texts never stands
    in memory a second time as Python strings."""
    return (value.as_py() for value in column)


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """`df` with the columns called like one of `names` renamed, and the list
    that selects all of its columns again under their own names."""
    taken = {n.lower() for n in names}
    marks = {c: f"_aside_{k}" for k, c in enumerate(df.columns) if c.lower() in taken}
    return df.withColumnsRenamed(marks), [F.col(f"`{marks.get(c, c)}`").alias(c) for c in df.columns]


def first_by_hash(rows: DataFrame, keys: list[str], per_key: int) -> DataFrame:
    """(keys, h) of at most `per_key` distinct values of the hash `h` for each
    value of `keys` (not null): those that come first by their low 31 bits.

    Distinct hashes are counted per key first, and of a key that has more than
    needed only the share of the hash range that should hold eight times
    `per_key` is kept. So a key that holds a third of all rows sends a few
    thousand hashes to the task that ranks them, whatever the table's size.
    """
    every = rows.select(*keys, "h").distinct()
    sizes = every.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    low = F.pmod(F.col("h"), F.lit(1 << 31))
    held = every.join(F.broadcast(sizes), keys)
    held = held.where(low < F.lit(8.0 * per_key * (1 << 31)) / F.col("_size"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(low, "h"))
    return held.withColumn("_k", rank).where(F.col("_k") <= per_key).drop("_k")


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts, summed by Spark."""
    return df.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0


def ship_package(spark: SparkSession, _sent: set[str] = set()) -> None:  # noqa: B006  once per application
    """Send this package to the Python workers, once per application.

    The workers import the operators' task code by name; this spares the
    caller `--py-files` or a common PYTHONPATH.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="logsieve-py-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in [*package.rglob("*.py"), package.parent / "corpus_pipeline.py"]:
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
