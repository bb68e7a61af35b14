"""Embedding whitening with distributed block matrices (Spark MLlib)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix, RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsieve.llm.common import staged

#: Entries go to whole steps of 1 / SCALE above -OFFSET / SCALE.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows of a block; with 64 columns of doubles, half a megabyte.
BLOCK_ROWS = 1024
#: Blocks that one task multiplies before the products are added up.
TASK_BLOCKS = 8
#: A direction whose variance is below this share of the largest is empty.
EMPTY_SHARE = 1e-12
#: Entries from here on have no whole step in a long; their rows are dropped.
LARGEST = float(1 << 31)


@dataclass
class Whitening:
    """What `fit_whitening` learned: rows, exact sums of the whole steps by
    dimension, eigenvalues of the covariance (falling) and unit eigenvectors
    as columns, both only of directions that are not empty, and its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        """Projects centred rows to unit variance along every component."""
        return self.vectors / np.sqrt(self.values)


def whole_steps(vector: Column) -> Column:
    """floor(SCALE * c) + OFFSET of every entry, as long."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(OFFSET))


def usable(vector: Column) -> Column:
    """True for vectors whose entries are all finite and of a usable size."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= F.lit(LARGEST)))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def indexed_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(index, id, x) for the usable vectors, indexed from 0 without a gap.

    Staged with the place of each row in its part; the parts' offsets come
    from a count of each part, so no row is moved to be numbered. Vectors of
    another length than the commonest (the longest of those) are dropped.
    """
    vector = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v")).where(usable(F.col("v")))
    commonest = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("v") == (commonest["d"] if commonest else 0))
    rows = rows.select("id", whole_steps(F.col("v")).alias("x"), F.monotonically_increasing_id().alias("place"))
    rows = staged(rows, "whitening-rows").withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    return rows.join(parts, "part").select((F.col("ahead") + F.expr("place & 8589934591")).alias("index"), "id", "x")


def _exact(limit: int) -> str:
    """A type that holds whole numbers up to `limit`."""
    return "long" if limit < 1 << 62 else "decimal(38,0)"


def _moments(rows: DataFrame) -> tuple[int, list[int], int]:
    """Rows, exact sums by dimension, and the widest range of a dimension."""
    by_place = rows.select(F.posexplode("x")).groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("col").cast("decimal(20,0)")).alias("s"),
        F.max("col").alias("high"), F.min("col").alias("low"),
    )
    found = sorted(by_place.collect())
    if not found:
        return 0, [], 0
    return found[0]["n"], [int(r["s"]) for r in found], max(r["high"] - r["low"] for r in found)


def _centred(rows: DataFrame, n: int, sums: list[int], width: int) -> DataFrame:
    """(index, id, deviation, vector): the exact sum of (n * x - S)^2, and x - S / n.

    With m = S div n, n * x - S is n * (x - m) - S mod n: small whole numbers,
    exact in longs (in decimals where n times the range is beyond them).
    """
    most = n * (width + 1)
    term, total = _exact(most), _exact(len(sums) * most * most)
    floors, rests = (F.lit(part).cast("array<long>") for part in ([s // n for s in sums], [s % n for s in sums]))
    steps = F.zip_with("x", floors, lambda x, m: (x - m).cast(term) * F.lit(n).cast(term))
    rows = rows.withColumn("y", F.zip_with(steps, rests, lambda a, r: (a - r.cast(term)).cast(term)))
    squares = F.transform("y", lambda y: F.try_multiply(y.cast(total), y.cast(total)).cast(total))
    deviation = F.aggregate(squares, F.lit(0).cast(total), lambda a, b: F.try_add(a, b).cast(total))
    vector = F.transform("y", lambda y: y.cast("double") / F.lit(float(n)))
    return rows.select("index", "id", deviation.cast("decimal(38,0)").alias("deviation"), array_to_vector(vector).alias("vector"))


def _blocks(rows: DataFrame, vector_col: str, n: int, width: int) -> BlockMatrix:
    """The rows (index, vector) as a matrix of blocks of BLOCK_ROWS whole rows."""
    old = MLUtils.convertVectorColumnsFromML(rows.select("index", F.col(vector_col).alias("vector")), "vector")
    return IndexedRowMatrix(old, n, width).toBlockMatrix(BLOCK_ROWS, width)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left times right, the common dimension cut into `splits` tasks whose
    products are then added up; PySpark's own call always takes one."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, a local array of columns by columns."""
    splits = max(1, blocks.numRowBlocks // TASK_BLOCKS)
    return _product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()


def fit_whitening(blocks: BlockMatrix, n: int, sums: list[int], components: int) -> Whitening:
    """Eigenvectors of the covariance (divisor n) of centred rows."""
    covariance = scatter(blocks) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = (values > max(values[0], 0.0) * EMPTY_SHARE) & (np.arange(len(values)) < components)
    return Whitening(n, sums, values[keep], vectors[:, keep], float(np.trace(covariance)))


def project(spark: SparkSession, blocks: BlockMatrix, model: Whitening) -> DataFrame:
    """(index, whitened array): the rows times the whitening matrix."""
    d, k = model.matrix.shape
    rows = [(i, row.tolist()) for i, row in enumerate(model.matrix)]
    table = spark.createDataFrame(rows, "index long, entries array<double>")
    right = MLUtils.convertVectorColumnsFromML(table.select("index", array_to_vector("entries").alias("vector")), "vector")
    whitened = blocks.multiply(IndexedRowMatrix(right, d, k).toBlockMatrix(d, k))
    java = BlockMatrix(whitened._java_matrix_wrapper._java_model, BLOCK_ROWS, k).toIndexedRowMatrix()
    out = callMLlibFunc("getIndexedRows", java._java_matrix_wrapper._java_model)
    return out.select("index", vector_to_array("vector").alias("whitened"))


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest entry of the whitened rows' covariance (divisor n) less the identity."""
    rows = MLUtils.convertVectorColumnsFromML(whitened.select(array_to_vector("whitened").alias("vector")), "vector")
    covariance = RowMatrix(rows, n, k).computeCovariance().toArray() * ((n - 1) / n)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error)
    for every usable vector and component from 1, by falling eigenvalue.

    Fitted on all usable vectors, each entry c as the whole step
    x = floor(64 c) + 1,000,000. n counts them; deviation is the exact sum of
    (n * x - S)^2, S the dimension's sum of x, as decimal(38,0) (null beyond
    38 digits). whitened is x - S / n along the component over the root of its
    eigenvalue; its sign is arbitrary but one for all rows.

    Vectors that are null or empty, or hold null or non-finite entries or ones
    of 2^31 or more, are dropped, as are those of another length than the
    commonest. Directions without variance (below 1e-12 of the largest
    eigenvalue) are no components: fewer rows come out, and none if all
    vectors are equal or the table is empty. Ids that are null or repeat get
    rows of their own. Other columns are not read.

    Rows are numbered, cut into blocks and multiplied by Spark; what reaches
    the driver is of the size of the covariance.
    """
    spark = vectors.sparkSession
    rows = indexed_rows(vectors, id_col, vector_col)
    n, sums, width = _moments(rows)
    kind = vectors.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"id {kind}, component int, n long, deviation decimal(38,0), whitened double,"
                                  " explained double, identity_error double").withColumnRenamed("id", id_col)
    if n == 0 or width == 0:
        return empty
    centred = _centred(rows, n, sums, width)
    blocks = _blocks(centred, "vector", n, len(sums))
    model = fit_whitening(blocks, n, sums, components)
    whitened = staged(project(spark, blocks, model), "whitened")
    error = identity_error(whitened, n, len(model.values))
    each = whitened.join(centred.select("index", "id", "deviation"), "index")
    each = each.select("id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    shares = F.lit([float(v / model.trace) for v in model.values])
    return each.select(
        F.col("id").alias(id_col), (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )
