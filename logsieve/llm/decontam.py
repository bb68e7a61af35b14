"""Benchmark decontamination: a broadcast hash set of item word n-grams, as sorted arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.common import each, set_aside, staged, text_bytes, without

#: Words of a lower-cased UTF-8 text: digits, letters and all non-ASCII bytes.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Benchmark bytes whose windows are broadcast at a time.
BLOCK_BYTES = 4 << 20

_ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
])
_ADDED_ARROW = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())]


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


_STEP, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _hashes(ids: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the windows of `length` ids that begin at `at`."""
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(length):
        out = (out ^ (out >> np.uint64(29))) * _STEP + (ids[at + j].astype(np.uint64) + np.uint64(1)) * _LAST
    return out


class WindowSet:
    """The windows of some items as arrays: by length, the sorted hashes of all
    windows and where each begins in the word ids of all items, which a hit is
    verified against. About 20 bytes a window, and the vocabulary."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        parts = []
        for _, text in items:
            words = words_of(text)
            parts.append(np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words), np.int32, len(words)))
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.minimum(sizes, n)
        for length in np.unique(lengths[lengths > 0]).tolist():
            places = [np.arange(a, a + size - length + 1) for a, size, own in zip(self.first, sizes, lengths) if own == length]
            at = np.concatenate(places)
            hashes = _hashes(self.ids, at, length)
            order = np.argsort(hashes, kind="stable")
            self.by_length[length] = hashes[order], at[order].astype(np.int32 if len(self.ids) < 1 << 31 else np.int64)

    def nbytes(self) -> int:
        """Bytes of the arrays, and of the vocabulary's words and entries."""
        arrays = self.ids.nbytes + self.first.nbytes + sum(h.nbytes + p.nbytes for h, p in self.by_length.values())
        return arrays + sum(map(len, self.vocabulary)) + 160 * len(self.vocabulary)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and whose windows occur."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        hit, items = np.zeros(len(ids), dtype=bool), set()
        known = np.r_[0, np.cumsum(ids >= 0)]
        for length, (hashes, places) in self.by_length.items():
            # Only a run of `length` known words can be a window.
            at = np.flatnonzero(known[length:] - known[:-length] == length) if len(ids) >= length else ids[:0]
            own = _hashes(ids, at, length) if len(at) else hashes[:0]
            low, high = (np.searchsorted(hashes, own, side=s) for s in ("left", "right"))
            for start, a, b in zip(*(x[low < high].tolist() for x in (at, low, high))):
                window = ids[start : start + length]
                same = (self.ids[places[a:b][:, None] + np.arange(length)] == window).all(axis=1)
                if same.any():
                    hit[start : start + length] = True
                    owners = np.searchsorted(self.first, places[a:b][same], side="right") - 1
                    # An item without an id still marks words; it is in no list of items.
                    items.update(self.items[k] for k in set(owners.tolist()) if self.items[k] is not None)
        return hit, items


def scan_benchmark(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", bench_id: str = "item_id",
    bench_text: str = "text", n: int = 13, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`docs` with n_words, n_hit, hit_spans and item_ids added.

    A window is n consecutive words of a benchmark item, or the whole of an
    item of fewer words. A document word inside any occurrence of a window is
    hit. hit_spans holds the runs of hit words as [first, after last] word
    positions; item_ids the ids, sorted as strings, of items with a window in
    the document. Null and empty texts have no words, texts of any length are
    read whole; an empty benchmark hits nothing, an empty `docs` gives no row;
    repeated items and windows count for each item id; repeated rows give a
    row each. Input columns named like an added one are replaced.

    The benchmark's bytes are measured first. At most about `block_bytes` of it
    are broadcast at a time, as one window set, whose built size grows with
    them alone. A benchmark of one block is scanned without a shuffle or a
    written table. For a larger one the documents are written once with a row
    number; each block is a job of its own, which writes what it found by row
    number and gives its broadcast back before the next; then what all found
    is joined to the documents.
    """
    items = benchmark.select(F.col(bench_id).cast("string").alias("i"), F.col(bench_text).alias("t"))
    blocks = max(1, -(-text_bytes(items, "t") // block_bytes))
    source, send = without(docs, _ADDED.names), docs.sparkSession.sparkContext.broadcast
    if blocks == 1:
        windows = send(WindowSet([tuple(r) for r in items.collect()], n))
        return source.mapInArrow(_scanner(windows, text_col), T.StructType([*source.schema.fields, *_ADDED.fields]))

    mark = "_row"
    while mark in map(str.lower, source.columns):
        mark = "_" + mark
    rows = staged(source.withColumn(mark, F.monotonically_increasing_id()), "decontam-docs")
    keyed = rows.select(mark, text_col)
    schema = T.StructType([T.StructField(mark, T.LongType()), *_ADDED.fields])
    found = []
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        windows = send(WindowSet([tuple(r) for r in own.collect()], n))
        scanned = keyed.mapInArrow(_scanner(windows, text_col, mark), schema)
        # the first block counts the words of every document
        found.append(staged(scanned.where("n_hit > 0") if k else scanned, "decontam-hits"))
        windows.destroy()
    merged = reduce(DataFrame.unionByName, found).groupBy(mark).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hit_spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    merged = merged.withColumn("hit_spans", _joined(F.array_sort("spans"))).drop("spans")
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s[1] - s[0])
    return rows.join(merged.withColumn("n_hit", n_hit), mark).select(*[f"`{c}`" for c in source.columns], *_ADDED.names)


def _joined(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    def add(done: Column, span: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        begun = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        longer = F.concat(begun, F.array(F.array(F.get(last, 0), F.greatest(F.get(last, 1), F.get(span, 1)))))
        return F.when(F.get(last, 1) >= F.get(span, 0), longer).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast("array<array<bigint>>"), add)


def _scanner(windows, text_col: str, key: str | None = None):
    """Adds what is found to the rows, or gives it beside the column `key` alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = windows.value
        for batch in batches:
            made: list[list] = [[], [], [], []]
            for text in each(batch.column(text_col)):
                words = words_of(text)
                hit, items = found.hits(words)
                edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0])).reshape(-1, 2).tolist()
                for column, value in zip(made, (len(words), int(hit.sum()), edge, sorted(items))):
                    column.append(value)
            if key is not None:
                batch = batch.select([key])
            for name, kind, column in zip(_ADDED.names, _ADDED_ARROW, made):
                batch = batch.append_column(name, pa.array(column, kind))
            yield batch

    return run


def contaminated(share: int = 20) -> Column:
    """Hit at all, and one word in `share` or more is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` less the contaminated documents; all other rows unchanged."""
    docs, own = set_aside(docs, _ADDED.names)
    return scan_benchmark(docs, benchmark, **options).where(~contaminated()).select(*own)


def cut_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """`docs` with every run of hit words cut out of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = each(batch.column(text_col)), each(batch.column("hit_spans"))
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, text_col, pa.array(map(_cut, texts, spans), pa.string()))

    docs, own = set_aside(docs, _ADDED.names)
    scanned = scan_benchmark(docs, benchmark, text_col=text_col, **options)
    return scanned.mapInArrow(run, scanned.schema).select(*own)


def _cut(text: str | None, spans) -> str | None:
    if text is None or not len(spans):
        return text
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in WORD.finditer(raw.lower())]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last : at[int(a)][0]])
        last = at[int(b) - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")
