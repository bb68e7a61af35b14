"""SimHash near-dedup by pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import each, staged
from logsieve.llm.components import connected_components, local_roots

#: Fingerprints of a block; a larger bucket is compared block by block.
BLOCK = 512
#: Reference fingerprints of the pivot table.
PIVOTS = np.random.default_rng(42).integers(0, 2**64, 32, dtype=np.uint64)
#: Shingles whose hashes are unpacked to bits at a time.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a whole text; 0 for null or no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    hashes = np.array(list(map(partial(xxhash.xxh64_intdigest, seed=seed), grams)), dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def simhash_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """(id, fp) for every row: fp is the fingerprint as a signed long.

    Words are runs without ASCII white space, A-Z lower-cased; shingles keep
    repeats; a text of fewer words is one shingle; null or empty text is 0.
    """
    return _fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle, seed)


def _fingerprints(source: DataFrame, shingle: int, seed: int) -> DataFrame:
    """`source` with `fp` in place of `text`."""
    carried = [c for c in source.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in each(batch.column("text"))], dtype=np.uint64)
            columns = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps.view(np.int64))], [*carried, "fp"])

    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in carried)
    return source.mapInArrow(run, f"{kinds}, fp long")


def band_masks(max_bits: int, distinct: int) -> list[int]:
    """Masks such that fingerprints within `max_bits` agree under one of them.

    64 bits are cut into b blocks; `max_bits` differences leave b - max_bits
    blocks equal, and there is a mask for each such choice. b is the least
    for which a bucket of random fingerprints is expected to hold at most 64.
    """
    b = max_bits + 1
    while b < 2 * max_bits and distinct > 64 * 2.0 ** (64 * (b - max_bits) / b):
        b += 1
    edges = [64 * k // b for k in range(b + 1)]
    blocks = [((1 << edges[k + 1]) - (1 << edges[k])) for k in range(b)]
    return [sum(c) for c in combinations(blocks, b - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int):
    """Of the candidates (a[i], b[j]), those within `max_bits`: the pivot
    tables discard a pair when any coordinate differs by more, the rest are
    verified."""
    for p in PIVOTS:
        da, db = (np.bitwise_count(x ^ p).astype(np.int8) for x in (a, b))
        near = np.abs(da[i] - db[j]) <= max_bits
        i, j = i[near], j[near]
        if not len(i):
            return i, j
    near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
    return i[near], j[near]


def _run_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of equal neighbours in sorted keys."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    end = np.repeat(first + size, size)
    later = end - np.arange(len(keys)) - 1
    i = np.repeat(np.arange(len(keys)), later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    return i, j


def links_of(pdf: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """A spanning forest of the links among one group's fingerprints."""
    pdf = pdf.sort_values(["key", "fp"], ignore_index=True)
    fps = pdf["fp"].to_numpy().view(np.uint64)
    if pdf["gj"].iloc[0] > pdf["gi"].iloc[0]:  # two blocks of a large bucket
        left, right = (np.flatnonzero(pdf["part"] == pdf[c].iloc[0]) for c in ("gi", "gj"))
        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
    else:
        i, j = _run_pairs(pdf["key"].to_numpy())
    i, j = near_pairs(fps, fps, i, j, max_bits)
    root = local_roots(len(fps), i, j)
    tied = np.flatnonzero(root != np.arange(len(fps)))
    return pd.DataFrame({"a": fps[tied].view(np.int64), "b": fps[root[tied]].view(np.int64)})


def hamming_links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct
    fingerprints `fp` at most `max_bits` apart.

    Candidates agree under one of the band masks, which loses no pair. A
    bucket of over BLOCK fingerprints is split into blocks, and every pair of
    blocks is a group of its own, so no group exceeds 2 x BLOCK rows of a
    bucket. Small buckets are put together into groups of a few thousand
    rows. Within a group the pivot distance tables discard pairs and the
    survivors are verified; a group returns a spanning forest of its links,
    never all pairs.
    """
    n = classes.count()
    masks = [_signed(m) for m in band_masks(max_bits, n)]
    bands = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)
    ])).alias("s")).select("fp", "s.band", "s.key")
    sizes = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    cells = max(1, n * len(masks) // 8192)
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = bands.join(sizes, ["band", "key"]).withColumn("parts", parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "fp", "key", "part", "band",
        F.when(F.col("parts") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(cells))).alias("cell"),
        (F.col("parts") > 1).alias("large"),
        F.least("part", "other").alias("gi"), F.greatest("part", "other").alias("gj"),
    )
    return rows.groupBy("band", "large", "cell", "gi", "gj").applyInPandas(
        lambda pdf: links_of(pdf, max_bits), "a long, b long"
    )


def simhash_near_dups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = 3, max_bits: int = 3, seed: int = 42,
) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of `docs`.

    Rows with fingerprints `max_bits` or fewer bits apart are linked;
    component_id is the smallest id reachable by links. Rows of one
    fingerprint are one class, so copies are never compared with each other.
    Null and empty texts have fingerprint zero and link like any other.
    Repeated ids give a row each. A null id keeps its row and can carry links
    but is no component_id unless all ids reached are null. Other columns are
    ignored. No rows in, no rows out.
    """
    prints = staged(simhash_fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    members = _members(prints.groupBy("fp").agg(F.min("id").alias("rep")), max_bits)
    least = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = members.join(least, "component").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _members(classes: DataFrame, max_bits: int) -> DataFrame:
    """`classes`, a row for each fingerprint `fp`, with their `component`."""
    classes = staged(classes, "classes")
    linked = connected_components(hamming_links(classes, max_bits))
    return classes.join(linked, classes["fp"] == linked["node"], "left").select(
        *[classes[c] for c in classes.columns], F.coalesce("component", "fp").alias("component")
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = 3, max_bits: int = 3, seed: int = 42,
) -> DataFrame:
    """`docs` less every document that is not the one its group keeps.

    Of a group's rows with an id, the first by (id, fingerprint, text hash)
    stays, so an id that names several texts keeps a row in each group that
    has it as its least; of rows equal in id and text one stays. A row
    without an id never goes in favour of one with an id: of these rows each
    group keeps one too.
    """
    source = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text")
    )
    prints = staged(_fingerprints(source, shingle, seed), "fingerprints")
    named = F.col("id").isNotNull()
    members = _members(prints.groupBy("fp").agg(
        F.min(F.when(named, F.struct("id", "fp", "h"))).alias("first"),
        F.min(F.when(~named, F.struct("fp", "h"))).alias("bare"),
    ), max_bits)
    least = members.groupBy("component").agg(F.min("first").alias("first"), F.min("bare").alias("bare"))
    keeps = members.select("fp", "component").join(least, "component").select("fp", "first", "bare")
    rows = prints.groupBy("id", "h", "fp").agg(F.count(F.lit(1)).alias("_rows")).join(keeps, "fp")
    kept = F.when(named, F.struct("id", "fp", "h") == F.col("first")).otherwise(F.struct("fp", "h") == F.col("bare"))
    gone = staged(rows.select(
        F.col("id").alias("_id"), F.col("h").alias("_h"), "_rows", kept.alias("_kept")
    ).where("not _kept or _rows > 1"), "groups")

    def same(keys: DataFrame) -> Column:
        return docs[id_col].eqNullSafe(keys["_id"]) & (F.xxhash64(docs[text_col]) == keys["_h"])

    once = docs.join(gone, same(gone), "left_anti")
    twice = gone.where("_kept")
    if twice.isEmpty():
        return once
    again = docs.join(twice, same(twice), "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(again)
