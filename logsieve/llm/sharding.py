"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` points of a ring; a key belongs to the shard of the
first point clockwise of its hash, its home. A shard is full once it holds its
capacity, the mean load and a little more. Keys that a full shard cannot take
continue clockwise to the next point of a shard that is not full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsieve.llm.common import set_aside, staged

LAW = "bytes"
#: A shard may hold the mean and a thousandth.
SLACK = (1, 1000)
VNODES = 64
#: Sizes are told apart by power of two, this many of them.
SIZE_CLASSES = 32
#: Cells whose loads the plan is made from, about; the driver holds no more.
CELLS = 1 << 19


class Ring:
    """The virtual nodes of shards 0 to n - 1, in ring order."""

    def __init__(self, shards: int, vnodes: int = VNODES) -> None:
        points = sorted((xxhash.xxh64(f"shard {s} point {v}", seed=42).intdigest(), s) for s in range(shards) for v in range(vnodes))
        self.shards = shards
        self.points = np.array([p for p, _ in points], dtype=np.uint64)
        self.owner = np.array([s for _, s in points], dtype=np.int32)
        #: hash buckets that keys of one arc and size class are dealt into
        self.buckets = max(1, CELLS // (len(points) * SIZE_CLASSES))

    def arcs(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash (64 bits) the first point at or after it, the first of all past the last."""
        return np.searchsorted(self.points, hashes.view(np.uint64), side="left") % len(self.points)

    def cells(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The order in which a shard takes keys: larger size class first, then
        by hash bucket, then by arc. Keys of one cell stay together."""
        size_class = np.minimum(np.frexp(sizes.astype(np.float64))[1], SIZE_CLASSES - 1)
        bucket = (hashes.view(np.uint64) % np.uint64(self.buckets)).astype(np.int64)
        return ((SIZE_CLASSES - 1 - size_class) * self.buckets + bucket) * len(self.points) + self.arcs(hashes)

    def next_open(self, open_: np.ndarray) -> np.ndarray:
        """For each point the first open shard at or clockwise of it."""
        at = np.flatnonzero(np.tile(open_[self.owner], 2))
        ahead = at[np.searchsorted(at, np.arange(len(self.points)))]
        return self.owner[ahead % len(self.points)]


@dataclass
class Loads:
    """Which keys each shard takes: one (shard of each arc, first cell refused
    by each shard) a round. At most one round for every shard."""

    ring: Ring
    capacity: int
    rounds: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def planned(cls, ring: Ring, cells: np.ndarray, loads: np.ndarray, slack: tuple[int, int]) -> Loads:
        """Fill the shards from the loads of the ring's cells.

        In each round every key left asks the next shard clockwise that was not
        full at its start. A shard takes cells in their order while it holds
        less than its capacity. So a home keeps its own keys before any that
        come from elsewhere, and a shard holds less than its capacity and one
        cell. Each round fills a shard or places all, and as the capacities
        hold more than all keys, none is left over.
        """
        order = np.argsort(cells)
        cells, loads = cells[order], loads[order]
        total = sum(int(x) for x in loads)
        capacity = max(1, -(-total * (slack[0] + slack[1]) // (ring.shards * slack[1])))
        plan, held, left = cls(ring, capacity), np.zeros(ring.shards, dtype=np.int64), np.ones(len(cells), dtype=bool)
        while True:
            to = ring.next_open(held < capacity)
            refused = np.full(ring.shards, np.iinfo(np.int64).max)
            target = to[cells % len(ring.points)]
            for s in np.flatnonzero(held < capacity):
                mine = np.flatnonzero(left & (target == s))
                before = held[s] + np.cumsum(loads[mine]) - loads[mine]
                taken = int(np.searchsorted(before, capacity, side="left"))
                if taken < len(mine):
                    refused[s] = cells[mine[taken]]
                held[s] += loads[mine[:taken]].sum()
                left[mine[:taken]] = False
            plan.rounds.append((to, refused))
            if not left.any():
                return plan

    def shards(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The shard of each key."""
        arcs, cells = self.ring.arcs(hashes), self.ring.cells(hashes, sizes)
        out = np.full(len(arcs), -1, dtype=np.int32)
        for to, refused in self.rounds:
            target = to[arcs]
            out = np.where((out < 0) & (cells < refused[target]), target, out)
        return out


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` with size, text_crc32 and _hash: the hash of the id, or of the
    text's checksum where there is no id."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit("text "), crc.cast("string")))
    return docs.withColumns({"size": F.octet_length(text).cast("long") + 1, "text_crc32": crc, "_hash": F.xxhash64(key)})


def plan_loads(keys: DataFrame, shards: int, vnodes: int = VNODES, slack: tuple[int, int] = SLACK) -> Loads:
    """The plan for `keys` (_hash, size). Only the loads of cells reach the
    driver: at most CELLS of them, or SIZE_CLASSES for each point if there are
    more points than that leaves, however many keys there are."""
    ring = Ring(shards, vnodes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_hash", "size"))
            yield pa.RecordBatch.from_arrays([pa.array(ring.cells(hashes, sizes)), batch.column("size")], names=["cell", "load"])

    loads = keys.select("_hash", "size").mapInArrow(cells, "cell long, load long")
    loads = loads.groupBy("cell").agg(F.sum("load").alias("load")).toArrow()
    return Loads.planned(ring, loads["cell"].to_numpy(), loads["load"].to_numpy(), slack)


def shard_of(plan: Loads) -> Callable[..., Column]:
    """Column function (_hash, size) -> shard: a lookup in the plan, batch by batch."""

    @F.pandas_udf("int")
    def shard(hashes: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series(plan.shards(hashes.to_numpy(), sizes.to_numpy()))

    return shard


def write_shards(docs: DataFrame, path: str, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text",
                 vnodes: int = VNODES, slack: tuple[int, int] = SLACK) -> Loads:
    """Write `docs` as Parquet under `path`, a folder shard=N for each shard,
    and return the plan. Every task writes its own rows: nothing is shuffled.
    The texts are read twice. An input column called shard, size, text_crc32
    or _hash in any case keeps its values in _aside_N columns."""
    docs, _ = set_aside(docs, ["shard", "size", "text_crc32", "_hash"])
    rows = _measured(docs, id_col, text_col)
    plan = plan_loads(rows, shards, vnodes, slack)
    rows = rows.withColumn("shard", shard_of(plan)("_hash", "size")).drop("_hash")
    rows.write.partitionBy("shard").parquet(path)
    return plan


def shard_documents(docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text",
                    vnodes: int = VNODES, slack: tuple[int, int] = SLACK) -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, grown_shard) for every row.

    size is the text's UTF-8 bytes and 1 (null: 1). The law is `bytes`: a
    shard holds less than the mean, a thousandth more (`slack`), and one cell
    of keys, so sizes are near equal. Large texts are placed before small
    ones, which then fill shards to the brim; one text larger than the mean
    still makes its shard as large as itself. grown_shard is null: with
    bounded loads one more shard also moves some keys between the others.

    slot numbers the rows of a shard from 0 without a gap, in the order of the
    parts of one staged narrow table, so a row keeps its slot whatever is lost
    and recomputed. Another layout of the input may number them otherwise;
    shards do not depend on it.

    Rows without an id go by their text. Rows that share id and size are one
    key: they share a shard, with a slot each. An empty table gives no row.
    Other columns are not read. Texts are read once and never moved; the rows
    that meet in a task are those of one shard in one part of the staged table.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    keys = _measured(own, "_id", "_text").select("_id", "size", "text_crc32", "_hash")
    keys = staged(keys.withColumn("_row", F.monotonically_increasing_id()), "shard-keys")
    plan = plan_loads(keys, shards, vnodes, slack)
    rows = keys.withColumn("shard", shard_of(plan)("_hash", "size")).withColumn("_part", F.shiftright("_row", 33))

    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("shard", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_row")) - 1
    return rows.join(parts, ["shard", "_part"]).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_before") + inside).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
