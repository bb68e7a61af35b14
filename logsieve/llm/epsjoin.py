"""Embedding near-dedup by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsieve.llm.common import staged
from logsieve.llm.components import connected_components, local_roots

#: Leading principal dimensions of the grid order.
DIMENSIONS = 8
#: Vectors of a block, the shortest interval of the sequence.
BLOCK = 512
#: Children of an interval.
FANOUT = 8

_BLOCK_SCHEMA = (
    "block long, label string, dim int, nodes binary, copies binary, vectors binary, "
    "low array<double>, high array<double>"
)


def _norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda n, x: n + x.cast("double") * x.cast("double")))


def valid_vector(vector: Column) -> Column:
    """Not null or empty, every component finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal_axes(classes: DataFrame, dim: int, k: int = DIMENSIONS) -> np.ndarray:
    """The `k` leading principal axes (dim x k) of the unit vectors, by Spark's
    PCA over all of them; fewer than two vectors give the first axes."""
    k = min(k, dim)
    units = classes.where(F.col("dim") == dim).select(F.col("vector"), _norm(F.col("vector")).alias("norm"))
    units = units.select(array_to_vector(F.transform("vector", lambda x: x.cast("double") / F.col("norm"))).alias("v"))
    if len(units.take(2)) < 2:
        return np.eye(dim, k)
    return PCA(k=k, inputCol="v", outputCol="p").fit(units).pc.toArray()


def _projected(classes: DataFrame, axes: dict[int, np.ndarray], k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, out = batch.column("vector").to_pylist(), []
            for v in vectors:
                x = np.array(v, dtype=np.float64)
                p = x @ axes[len(x)] / np.linalg.norm(x)
                out.append(np.r_[p, np.zeros(k - len(p))])
            yield batch.append_column("place", pa.array(out, pa.list_(pa.float64())))

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(
        run, f"node long, label string, dim int, copies long, vector {kind}, place array<double>"
    )


def _blocks(placed: DataFrame, eps: float, k: int, size: int) -> DataFrame:
    """The grid order cut into blocks: vectors sorted by label and by the grid
    cells of their leading dimensions, `size` neighbours a row."""
    cells = [F.floor(F.col("place")[i] / eps) for i in range(k)]
    order = ["label", "dim", *[f"c{i}" for i in range(k)], "mixed", "node"]
    rows = placed.withColumns({f"c{i}": c for i, c in enumerate(cells)} | {"mixed": F.xxhash64("node")})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("node", "label", "dim", "copies", "vector", "place", F.spark_partition_id().cast("long").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seq = [], 0

        def block() -> pa.RecordBatch:
            place = np.array([r["place"] for r in held])
            return pa.RecordBatch.from_pydict({
                "block": [held[0]["part"] << 32 | seq], "label": [held[0]["label"]],
                "dim": pa.array([held[0]["dim"]], pa.int32()),
                "nodes": [np.array([r["node"] for r in held], dtype="<i8").tobytes()],
                "copies": [np.array([r["copies"] for r in held], dtype="<i8").tobytes()],
                "vectors": [np.array([r["vector"] for r in held], dtype=np.float64).tobytes()],
                "low": [place.min(axis=0)], "high": [place.max(axis=0)],
            })

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == size or (row["label"], row["dim"]) != (held[0]["label"], held[0]["dim"])):
                    yield block()
                    held, seq = [], seq + 1
                held.append(row)
        if held:
            yield block()

    return rows.mapInArrow(run, _BLOCK_SCHEMA)


def _gap(k: int) -> Column:
    """Squared distance of two intervals' boxes in the leading dimensions:
    no vectors of theirs are nearer, as a projection never moves them apart."""
    sides = [
        F.greatest(F.lit(0.0), F.col("b.low")[i] - F.col("a.high")[i], F.col("a.low")[i] - F.col("b.high")[i])
        for i in range(k)
    ]
    return reduce(lambda x, y: x + y, [s * s for s in sides])


def near_blocks(blocks: DataFrame, eps: float, k: int = DIMENSIONS, fanout: int = FANOUT) -> DataFrame:
    """(block_a, block_b), a <= b: every pair of blocks of one label that may
    hold vectors within `eps`.

    Intervals of the sequence form a tree of `fanout` children. Starting from
    each label's whole sequence against itself, every round joins the pairs
    of intervals with their children and skips the pairs whose boxes are
    provably distant. Only boxes move here, never vectors.
    """
    order = Window.partitionBy("label", "dim").orderBy("block")
    leaves = blocks.select("block", "label", "dim", "low", "high")
    leaves = staged(leaves.withColumn("at", F.row_number().over(order) - 1), "ego-boxes")
    longest = leaves.agg(F.max("at")).first()[0]
    if longest is None:
        return leaves.select(F.col("block").alias("block_a"), F.col("block").alias("block_b"))
    levels = [leaves]
    while longest >= 1:
        longest //= fanout
        low, high = (
            [f(F.col(c)[i]).alias(f"{c}{i}") for i in range(k)] for f, c in ((F.min, "low"), (F.max, "high"))
        )
        up = levels[-1].withColumn("at", F.floor(F.col("at") / fanout).cast("int"))
        up = up.groupBy("label", "dim", "at").agg(*low, *high)
        levels.append(up.select(
            "label", "dim", "at", F.array(*[f"low{i}" for i in range(k)]).alias("low"),
            F.array(*[f"high{i}" for i in range(k)]).alias("high"),
        ))
    pairs = levels[-1].select("label", "dim", F.col("at").alias("i"), F.col("at").alias("j"))
    for level in reversed(levels[:-1]):
        child = level.withColumn("up", F.floor(F.col("at") / fanout).cast("int"))
        found = pairs.alias("p").join(child.alias("a"), F.expr("a.label = p.label and a.dim = p.dim and a.up = p.i"))
        found = found.join(child.alias("b"), F.expr("b.label = p.label and b.dim = p.dim and b.up = p.j"))
        found = found.where(F.expr("a.at <= b.at") & (_gap(k) <= eps * eps + 1e-9))
        pairs = staged(found.select("p.label", "p.dim", F.col("a.at").alias("i"), F.col("b.at").alias("j")), "ego-pairs")
    ends = leaves.select("label", "dim", "at", "block")
    pairs = pairs.join(ends.withColumnsRenamed({"at": "i", "block": "block_a"}), ["label", "dim", "i"])
    pairs = pairs.join(ends.withColumnsRenamed({"at": "j", "block": "block_b"}), ["label", "dim", "j"])
    return pairs.select("block_a", "block_b")


def _unit(raw: bytes, dim: int) -> np.ndarray:
    x = np.frombuffer(raw, np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _join_blocks(pairs: DataFrame, blocks: DataFrame, min_cosine: float) -> DataFrame:
    """(a, b, links): a spanning forest (a, b) of each pair of blocks' links,
    and with b null the number of vectors each node links to there."""
    data = blocks.select("block", "dim", "nodes", "copies", "vectors")
    held = ("nodes", "copies", "vectors")
    left = data.select(F.col("block").alias("block_a"), "dim", *[F.col(c).alias(f"{c}_a") for c in held])
    right = data.select(F.col("block").alias("block_b"), *[F.col(c).alias(f"{c}_b") for c in held])
    rows = pairs.join(left, "block_a").join(right, "block_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                same = row["block_a"] == row["block_b"]
                a, b = (_unit(row[f"vectors_{x}"], row["dim"]) for x in "ab")
                ids_a, ids_b, n_a, n_b = (np.frombuffer(row[c], "<i8") for c in ("nodes_a", "nodes_b", "copies_a", "copies_b"))
                linked = a @ b.T >= min_cosine
                if same:
                    linked = np.triu(linked, 1)
                    linked |= linked.T
                i, j = np.nonzero(np.triu(linked) if same else linked)
                ids = ids_a if same else np.r_[ids_a, ids_b]
                root = local_roots(len(ids), i, j if same else j + len(ids_a))
                tied = np.flatnonzero(root != np.arange(len(ids)))
                links = linked @ n_b if same else np.r_[linked @ n_b, linked.T @ n_a]
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_pydict({
                    "a": np.r_[ids[tied], ids[some]],
                    "b": pa.array([*ids[root[tied]].tolist(), *[None] * len(some)], pa.int64()),
                    "links": np.r_[np.zeros(len(tied), dtype=np.int64), links[some]],
                })

    return rows.mapInArrow(run, "a long, b long, links long")


def embedding_near_dups(
    vectors: DataFrame, min_cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", dimensions: int = DIMENSIONS, block: int = BLOCK,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of `vectors`.

    Two rows link if their labels are equal and not null and the cosine of
    their vectors, in double precision, is `min_cosine` or more. n_links
    counts the other rows linked directly, component_id is the smallest id
    reachable by links, itself included, and kept marks the row whose id that
    is. Vectors that are null, empty, all zero, or hold a null or non-finite
    component link with nothing, nor do vectors of different lengths or rows
    without an id. Ids name vectors: rows that repeat an id share a node.
    Extra columns are ignored; no rows in, no rows out.

    Equal vectors of a label are one class of copies and never compared with
    each other. For unit vectors the cosine bound is a distance eps, so the
    classes are put in epsilon grid order of their leading principal
    dimensions, intervals of that order are joined recursively, and only the
    pairs of blocks left are compared, as one matrix product each. A pair of
    blocks returns link counts and a spanning forest, never all its pairs;
    the hash of the id ends the sort key, so a cell that holds a third of all
    vectors is cut into blocks like any other.
    """
    eps = float(np.sqrt(max(0.0, 2 - 2 * min_cosine)))
    row = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    )
    able = F.col("id").isNotNull() & F.col("label").isNotNull() & valid_vector(F.col("vector"))
    usable = row.where(able)
    classes = staged(usable.groupBy("label", "vector").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")
    ).select("node", "label", F.size("vector").alias("dim"), "copies", "vector"), "ego-classes")
    dims = [r[0] for r in classes.select("dim").distinct().collect()]
    axes = {d: principal_axes(classes, d, dimensions) for d in dims}
    blocks = staged(_blocks(_projected(classes, axes, dimensions), eps, dimensions, block), "ego-blocks")
    found = staged(_join_blocks(near_blocks(blocks, eps, dimensions), blocks, min_cosine), "ego-links")
    near = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("b is not null").select("a", "b"))

    many = classes.where("copies > 1").select("label", "vector", F.col("node").alias("first"), "copies")
    rows = row.withColumn("able", able).join(many, ["label", "vector"], "left")
    rows = rows.withColumn("node", F.coalesce("first", "id"))
    rows = rows.join(near, "node", "left").join(parts, "node", "left")
    links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    rows = rows.select(
        F.col("id").alias(id_col), F.when(F.col("able"), links).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("able"), F.coalesce("component", "node")).otherwise(F.col("id")).alias("component_id"),
    )
    return rows.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
