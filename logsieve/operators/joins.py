"""Joining a small per-key table back onto row-level data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    MapType,
    ShortType,
    StringType,
    StructType,
)

from logsieve.sources.scratch import scratch_path

# Broadcast only within both bounds, checked on the materialised small side.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


_FIXED_WIDTH = {ByteType: 1, BooleanType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4, DecimalType: 16}


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: actual length of strings and binaries, the
    JSON length of nested values, a fixed width (8 unless listed) otherwise."""
    total = F.lit(0)
    for field in df.schema.fields:
        c, t = F.col(field.name), field.dataType
        if isinstance(t, (StringType, BinaryType)):
            size = F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(t, (ArrayType, MapType, StructType)):
            size = F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            size = F.lit(_FIXED_WIDTH.get(type(t), 8))
        total = total + size
    return total


def _measured(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """`df` written once to a new scratch folder and read back, with its rows
    and value bytes, observed by that same write."""
    seen = Observation(name)
    size = F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")
    path = scratch_path(df.sparkSession, name)
    df.observe(seen, F.count(F.lit(1)).alias("rows"), size).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"], seen.get["bytes"]


def attach_small(
    large: DataFrame,
    small: DataFrame,
    condition: Column,
    how: str = "left",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join `small` (e.g. per-service statistics) onto `large`.

    The small side is written to a new folder under the scratch root and
    measured by that write: row count and value bytes. The join reads it
    back, so it always sees the input as it is now (a cache entry would be
    found again by path when the folder has grown), nothing stays cached, and
    a lost executor costs a re-read. Within both bounds it is broadcast, so
    the large side is joined map-side with no shuffle. Beyond them a shuffle
    join runs, where AQE's skew handling splits any partition swollen by a
    heavy key.
    """
    small, rows, size = _measured(small, "small-side")
    if rows <= max_broadcast_rows and size <= max_broadcast_bytes:
        small = F.broadcast(small)
    return large.join(small, condition, how)


def restrict_to_keys(
    df: DataFrame, keys_df: DataFrame, keys: list[str], known_rows: int, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Rows of `df` whose `keys` appear in `keys_df`, and any whose keys share
    a 64-bit hash with one that does.

    `known_rows` bounds `keys_df`'s rows, from the plan (the n of a top-n).
    Only hashes are joined, 8 bytes a row however long the keys are, so
    within `max_broadcast_rows` the broadcast side has a proven size and the
    filter runs map-side; beyond it a shuffle semi-join runs. The caller
    ranks the few groups that come out again, which drops a chance collision.
    """
    hashes = keys_df.select(F.xxhash64(*keys).alias("_keys_hash"))
    if known_rows <= max_broadcast_rows:
        hashes = F.broadcast(hashes)
    return df.join(hashes, F.xxhash64(*keys) == F.col("_keys_hash"), "left_semi")
