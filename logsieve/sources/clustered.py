"""A log table clustered for filters on service and time.

Rows are sorted along a Z-order curve: the bits of a service rank and of a
time rank interleaved. Neighbouring rows are then close in both, so the
minimum and maximum that Parquet keeps of every row group are narrow in both,
and a filter on either or on both skips most row groups. Bloom filters do the
same for look-ups of single values in columns that the order ignores; where
values repeat so often that Parquet keeps a dictionary of them, it writes none
and the dictionary is searched instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from logsieve.functions import epoch_seconds

#: Each ranked column is cut into 2^RANK_BITS ranges of about equally many rows.
RANK_BITS = 6
BLOOM_COLUMNS = ("ip_address", "user_id")
#: Spark writes a TIMESTAMP as INT96 by default, of which Parquet keeps no bounds.
TIMESTAMP_TYPE_CONF, TIMESTAMP_TYPE = "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"


def order_number(column: str, kind: DataType) -> Column:
    """A long in the order of the column: seconds of a timestamp, the first
    seven bytes of a string, the whole part of a number."""
    if kind.typeName().startswith("timestamp"):
        return epoch_seconds(column, kind)
    if isinstance(kind, StringType):
        digits = F.rpad(F.substring(F.hex(F.encode(F.col(column), "UTF-8")), 1, 14), 14, "0")
        return F.conv(digits, 16, 10).cast("long")
    return F.col(column).cast("long")


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list[int]]:
    """For each column the numbers that cut its rows into 2^bits ranges: one
    pass of mergeable sketches, 2^bits - 1 numbers a column to the driver."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    sketches = [F.percentile_approx(order_number(c, df.schema[c].dataType), shares).alias(c) for c in columns]
    found = df.agg(*sketches).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def rank(value: Column, bounds: Sequence[int]) -> Column:
    """How many of the bounds are below `value`; null is 0, before all others."""
    out = F.lit(0)
    for b in bounds:
        out = out + F.when(value > b, 1).otherwise(0)
    return out


def interleave(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """The Z-order value: from the highest bit down, one bit of each rank in turn."""
    out = F.lit(0)
    for bit in range(bits):
        for k, r in enumerate(ranks):
            place = bit * len(ranks) + (len(ranks) - 1 - k)
            out = out + F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)), place)
    return out


def write_clustered(
    df: DataFrame, path: str, files: int, *, by: Sequence[str] = ("service", "timestamp"),
    bloom: Mapping[str, int] | Sequence[str] = BLOOM_COLUMNS, row_group_bytes: int | None = None,
) -> None:
    """Write `df` to `path` (replaced) in about `files` files along the Z-order
    curve of the columns `by`.

    `bloom` names columns that get a Bloom filter in each row group, or gives
    the number of distinct values to expect of each. `row_group_bytes` sets
    Parquet's row group size; smaller ones skip more finely.

    Ranks are quantile ranges, so a service that holds a third of all rows, or
    a busy hour, only takes more of the curve. Rows of equal place are dealt
    over neighbouring files by a hash of the row's other columns, so not even
    one service at one instant lands in one task. Ties are broken by the
    columns `by` inside a file; null ranks before all others. The session
    writes timestamps as TIMESTAMP_MICROS meanwhile, so that they have bounds.
    """
    bounds = rank_bounds(df, by)
    ranks = [rank(order_number(c, df.schema[c].dataType), bounds[c]) for c in by]
    others = [c for c, kind in df.dtypes if c not in by and not kind.startswith("map")]
    rows = df.withColumns({"_z": interleave(ranks), "_deal": F.xxhash64(*others) if others else F.lit(0)})
    rows = rows.repartitionByRange(files, "_z", "_deal").sortWithinPartitions("_z", *by).drop("_z", "_deal")
    writer = rows.write.mode("overwrite")
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        if isinstance(bloom, Mapping):
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(bloom[c]))
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    conf = df.sparkSession.conf
    before = conf.get(TIMESTAMP_TYPE_CONF)
    conf.set(TIMESTAMP_TYPE_CONF, TIMESTAMP_TYPE)
    try:
        writer.parquet(path)
    finally:
        conf.set(TIMESTAMP_TYPE_CONF, before)
