"""N-gram scoring by a weighted backoff automaton."""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import each, staged

#: Text bytes of a chunk of documents that is tokenised and scored together.
CHUNK_BYTES = 8 << 20
#: Pseudo-count of the failure arc: what a state gives to all words it has no arc for.
STRENGTH = 50.0
#: Bits of the gram hash that one hop of the exchange goes by at most.
RADIX_BITS = 12
#: Tokens of a long text that are read as one stretch, beside its others.
STRETCH = 512

_END = b""  # no word is empty

_CHUNK_SCHEMA = "chunk long, ids array<{id}>, train array<boolean>, lengths binary, texts binary"
_GRAM_SCHEMA = "unit long, length int, shard long, grams binary, counts binary"
_TOTAL_SCHEMA = "unit long, length int, shard long, totals binary"
_SCORE_SCHEMA = "id {id}, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _pack(values: np.ndarray) -> bytes:
    """Little-endian bytes, plane by plane, compressed."""
    octets = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(octets.T.tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    body = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(body, np.uint8).reshape(width, len(body) // width)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a gram from those of its head and its last word."""
    h = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ b) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


class Grams:
    """The grams of up to `order` words that end at each token of a chunk.

    `ends[n]` are their 64-bit hashes by token, `keys[n]` the distinct ones in
    ascending order and `at[n]` each token's place there; `real[n]` tells the
    tokens with so many words before them. The start of a document counts as
    one end token.
    """

    def __init__(self, texts: list[bytes], order: int):
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        vocabulary[_END]
        parts, sizes = [], []
        for text in texts:
            words = text.lower().split()
            words.append(_END)
            parts.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
            sizes.append(len(words))
        self.sizes = np.array(sizes, dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        tokens = np.concatenate(parts)
        hashes = np.array(list(map(xxhash.xxh64_intdigest, vocabulary)), dtype=np.uint64)
        word = hashes[tokens]
        del texts, words, vocabulary, parts, tokens  # a worker's peak is in the sorts below
        inside = np.arange(len(word), dtype=np.int32) - np.repeat(self.first.astype(np.int32), self.sizes)
        self.real, self.keys, self.at = {}, {}, {}
        head = None
        for n in range(1, order + 1):
            if n == 1:
                head = word
            else:
                before = np.r_[hashes[:1], head[:-1]]
                if n == 2:
                    before[self.first] = hashes[0]
                head = _mix(before, word)
                del before
            self.real[n] = inside >= n - 2
            self.keys[n], at = np.unique(head, return_inverse=True)
            self.at[n] = at.astype(np.int32)


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, ids, train, lengths, texts): neighbouring documents put together, texts compressed."""
    source = docs.select("id", "text", "train").withColumn("part", F.spark_partition_id().cast("long"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, train, texts, held, seq, id_type, part = [], [], [], 0, 0, None, 0

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "chunk": [part << 32 | seq], "ids": pa.array([ids], pa.list_(id_type)), "train": [train],
                "lengths": [_pack(np.array([len(t) for t in texts], dtype="<u4"))],
                "texts": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))],
            })

        for batch in batches:
            id_type = batch.column("id").type
            for name, text, use, part in zip(*(each(batch.column(c)) for c in range(4))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                ids.append(name)
                train.append(use)
                texts.append(raw)
                held += len(raw)
                if held >= chunk_bytes:
                    yield chunk()
                    ids, train, texts, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield chunk()

    return source.mapInArrow(run, _CHUNK_SCHEMA.format(id=kind))


def _texts(row: dict) -> list[bytes]:
    at = np.r_[0, np.cumsum(_unpack(row["lengths"], "<u4").astype(np.int64))]
    body = zstandard.ZstdDecompressor().decompressobj().decompress(row["texts"])
    return [body[a:b] for a, b in zip(at[:-1], at[1:])]


def _ranges(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges (first `bits` bits of the hash) that sorted keys fall in, and
    where each begins, the end added."""
    prefix = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), np.uint64)
    first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return prefix[first].astype(np.int64), np.r_[first, len(keys)]


def _requests(unit: int, length: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted grams and their counts, a row for each range that has any."""
    ranges, cut = _ranges(keys, bits)
    spans = list(zip(cut[:-1], cut[1:]))
    return pa.RecordBatch.from_pydict({
        "unit": pa.array([unit] * len(spans), pa.int64()), "length": pa.array([length] * len(spans), pa.int32()),
        "shard": pa.array(ranges, pa.int64()),
        "grams": pa.array([_pack(np.diff(keys[x:y], prepend=np.uint64(0))) for x, y in spans], pa.binary()),
        "counts": pa.array([_pack(counts[x:y].astype("<u8")) for x, y in spans], pa.binary()),
    })


def _gram_counts(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    """The distinct grams of every chunk with their counts in its training
    documents, a row for each range of the hash that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("chunk", "train", "lengths", "texts")}
                grams = Grams(_texts(row), order)
                train = np.repeat(np.array(row["train"], dtype=bool), grams.sizes)
                for n in range(1, order + 1):
                    counts = np.bincount(grams.at[n][train & grams.real[n]], minlength=len(grams.keys[n]))
                    yield _requests(row["chunk"], n, grams.keys[n], counts, bits)

    return chunks.select("chunk", "train", "lengths", "texts").mapInArrow(run, _GRAM_SCHEMA)


def _together(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of one range: their distinct grams in order, where each row's
    grams stand among them, and where each row's grams begin there."""
    grams = [np.cumsum(_unpack(r["grams"], "<u8"), dtype=np.uint64) for r in rows]
    cut = np.cumsum([0, *map(len, grams)])
    together = np.concatenate(grams)
    del grams
    keys, place = np.unique(together, return_inverse=True)
    return keys, place, cut


def _summed(rows: list[dict], keys: np.ndarray, place: np.ndarray) -> np.ndarray:
    totals = np.zeros(len(keys), dtype=np.int64)
    np.add.at(totals, place, np.concatenate([_unpack(r["counts"], "<i8") for r in rows]))
    return totals


def _answers(rows: list[dict], totals: np.ndarray, place: np.ndarray, cut: np.ndarray) -> pa.Table:
    return pa.table({
        "unit": pa.array([r["unit"] for r in rows], pa.int64()), "length": pa.array([r["length"] for r in rows], pa.int32()),
        "shard": pa.array([r["shard"] for r in rows], pa.int64()),
        "totals": pa.array([_pack(totals[place[x:y]].astype("<u8")) for x, y in zip(cut[:-1], cut[1:])], pa.binary()),
    })


def _sum_shard(table: pa.Table) -> pa.Table:
    """One shard: the corpus count of every gram, for each unit in the order
    that it sent them; and, as unit -1, the sum and number of those seen."""
    rows = table.to_pylist()
    keys, place, cut = _together(rows)
    totals = _summed(rows, keys, place)
    seen = struct.pack(">QQ", int(totals.sum()), int((totals > 0).sum()))
    return pa.concat_tables([_answers(rows, totals, place, cut), pa.table({
        "unit": pa.array([-1], pa.int64()), "length": pa.array([rows[0]["length"]], pa.int32()),
        "shard": pa.array([rows[0]["shard"]], pa.int64()), "totals": pa.array([seen], pa.binary()),
    })])


def hops(chunks: int, radix_bits: int = RADIX_BITS) -> list[int]:
    """Bits of the gram hash that each hop of the exchange goes by: in all
    those of as many shards as there are chunks, `radix_bits` at most a hop."""
    bits = max(0, chunks - 1).bit_length()
    n = max(1, -(-bits // radix_bits))
    return [bits * (k + 1) // n - bits * k // n for k in range(n)]


def _corpus_counts(asked: DataFrame, units: int, bits: list[int], used: int) -> DataFrame:
    """(unit, length, shard, totals): the corpus count of every gram asked for.

    `asked` is cut into ranges by the first `used` bits, the last of which are
    bits[0]. In the last hop a range is a shard, which adds up. Before it, the
    rows that about 2^bits[0] units send to one range are merged into one unit
    of about their size, which asks in narrower ranges for them all and hands
    the answers on. So a unit sends 2^bits[0] rows at most a hop, and rows grow
    with the units, not with units times shards.
    """
    if len(bits) == 1:
        return staged(asked.groupBy("length", "shard").applyInArrow(_sum_shard, _TOTAL_SCHEMA), "lm-totals")
    groups = -(-units >> bits[0]) or 1
    asked = staged(asked, "lm-asked").withColumn("group", F.pmod(F.xxhash64("unit"), F.lit(groups)))
    finer = used + bits[1]

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, place, _ = _together(rows)
        return pa.Table.from_batches([_requests(key[0].as_py(), key[1].as_py(), keys, _summed(rows, keys, place), finer)])

    def hand_on(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        _, place, cut = _together(rows)
        found = [_unpack(a["totals"], "<u8") for a in sorted(answers.to_pylist(), key=lambda a: a["finer"])]
        return _answers(rows, np.concatenate(found), place, cut)

    cell = ["group", "length", "shard"]
    inner = _corpus_counts(asked.groupBy(*cell).applyInArrow(merge, _GRAM_SCHEMA), groups, bits[1:], finer)
    above = inner.where("unit >= 0").select(
        F.col("unit").alias("group"), "length", F.shiftright("shard", bits[1]).alias("shard"),
        F.col("shard").alias("finer"), "totals",
    )
    back = asked.groupBy(*cell).cogroup(above.groupBy(*cell)).applyInArrow(hand_on, _TOTAL_SCHEMA)
    return staged(back.unionByName(inner.where("unit = -1")), "lm-totals")


class BackoffAutomaton:
    """The part of the smoothed n-gram automaton that a chunk's texts traverse.

    A state is a gram of 1 to order - 1 words that training text holds; the
    root is the empty one (state 0). An arc is a gram of a state's words and
    one more: from a state seen `from` times, a word seen `c` > 0 times after
    it has an arc of log10((c + strength * p) / (from + strength)), where p is
    the word's probability in the state without its first word. To that state
    leads the failure arc, of log10(strength / (from + strength)). The root
    has an arc for every word: log10((c + 0.5) / (N + 0.5 * (V + 1))).

    `fail_to`, `fail_weight` are by state; `arcs[n]` and `goes_to[n]` by gram
    of n words: whether there is an arc, its weight, and the state it enters.
    `strengths` are those of states of 1, 2, ... words.
    """

    def __init__(self, grams: Grams, totals: dict[int, np.ndarray], n_tokens: int, n_words: int, strengths: Sequence[float]):
        self.grams, self.order = grams, len(grams.keys)
        self.base = np.log10((totals[1] + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
        end = np.searchsorted(grams.keys[1], np.uint64(xxhash.xxh64_intdigest(_END)))
        offset = np.cumsum([1, *(len(grams.keys[n]) for n in range(1, self.order))])
        self.fail_to, self.fail_weight = np.zeros(offset[-1], np.int32), np.zeros(offset[-1])
        self.seen = {n: totals[n] > 0 for n in totals}
        self.arcs, self.goes_to, self.start = {1: self.base}, {}, 0
        for n in range(1, self.order + 1):
            size = len(grams.keys[n])
            tail = np.zeros(size, np.int32)
            if n > 1:
                head = np.zeros(size, np.int32)
                tail[grams.at[n]] = grams.at[n - 1]
                before = np.r_[end, grams.at[n - 1][:-1]]
                if n == 2:
                    before[grams.first] = end
                head[grams.at[n][grams.real[n]]] = before[grams.real[n]]
                k = strengths[n - 2]
                lower = 10.0 ** self.arcs[n - 1][tail]
                self.arcs[n] = np.log10((totals[n] + k * lower) / (totals[n - 1][head] + k))
                del before, head, lower
            if n < self.order:
                states = slice(offset[n - 1], offset[n])
                self.fail_to[states] = offset[n - 2] + tail if n > 1 else 0
                self.fail_weight[states] = np.log10(strengths[n - 1] / (totals[n] + strengths[n - 1]))
                self.goes_to[n] = np.where(self.seen[n], offset[n - 1] + np.arange(size), 0).astype(np.int32)
            else:
                self.goes_to[n] = (offset[n - 2] + tail).astype(np.int32) if n > 1 else tail
        self.level = np.repeat(np.arange(self.order, dtype=np.int8), [1, *(len(grams.keys[n]) for n in range(1, self.order))])
        if self.order > 1 and self.seen[1][end]:
            self.start = int(offset[0] + end)

    def traverse(self, stretch: int = STRETCH) -> np.ndarray:
        """log10 probability of every token, each text read once from left to
        right with the state carried along.

        All texts of the chunk step together. A long one is read in stretches
        that step side by side: a state is at most order - 1 words, so one that
        begins so many tokens early is in the text's own state when it counts.
        """
        grams, out = self.grams, np.zeros(len(self.grams.at[1]))
        per = -(-grams.sizes // stretch)
        text = np.repeat(np.arange(len(per)), per)
        inside = (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * stretch
        lead = np.where(inside > 0, self.order - 1, 0)
        begin = grams.first[text] + inside - lead
        steps = np.minimum(stretch, grams.sizes[text] - inside) + lead
        by_size = np.argsort(-steps, kind="stable")
        begin, steps, lead, inside = begin[by_size], steps[by_size], lead[by_size], inside[by_size]
        state = np.where(inside > 0, 0, self.start)
        for t, on in enumerate(np.searchsorted(-steps, -np.arange(steps[0]))):
            at = begin[:on] + t
            state, log_p = self._step(state[:on], at)
            counts = t >= lead[:on]
            out[at[counts]] = log_p[counts]
        return out

    def _step(self, state: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states and log10 probabilities on reading the tokens at
        `at`: failure arcs are followed down to a state with an arc."""
        log_p, into, level = np.zeros(len(at)), np.zeros(len(at), np.int32), self.level[state]
        for n in range(self.order, 0, -1):
            here = np.flatnonzero(level == n - 1)
            gram = self.grams.at[n][at[here]]
            arc = self.seen[n][gram] | (n == 1)
            taken, failed = here[arc], here[~arc]
            log_p[taken] += self.arcs[n][gram[arc]]
            into[taken] = self.goes_to[n][gram[arc]]
            log_p[failed] += self.fail_weight[state[failed]]
            state[failed] = self.fail_to[state[failed]]
            level[taken], level[failed] = -1, n - 2
        return into, log_p


def score_documents(
    docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text",
    order: int = 2, strength: float | Sequence[float] = STRENGTH, chunk_bytes: int = CHUNK_BYTES,
    radix_bits: int = RADIX_BITS,
) -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens, base_score, score) for every row.

    The model is learned from the rows where `trained` is true (null counts
    as true): every gram of up to `order` words of their whole texts, none
    pruned. Tokens are runs without ASCII white space, A-Z lower-cased, and
    one end per text. base_score is the sum of root arcs, score the sum along
    the automaton's path. Null and empty texts are one end token. Without a
    training row N and V are 0. Repeated rows score alike, whatever their
    ids; other columns are ignored; no rows in, no rows out. A text of any
    length is one row of one chunk, which then is as long as that text.

    `strength` is one pseudo-count for all states, or one for states of one
    word, of two, and so on to order - 1.

    Documents are put together into chunks of `chunk_bytes` and staged. A
    chunk sends its distinct grams, sorted and packed, to shards that are
    equal ranges of the gram hash; a shard adds the counts up and answers
    each chunk in the order of its question. Beyond 2^`radix_bits` shards
    this goes by several hops (`hops`), so that the rows exchanged grow with
    the chunks. The chunk then has just the arcs and failure arcs that its
    texts traverse, however large the model grows, and no word is a key that
    many rows meet on. Grams are told apart by 64-bit hashes.
    """
    strengths = [float(strength)] * (order - 1) if isinstance(strength, (int, float)) else list(strength)
    if len(strengths) != order - 1:
        raise ValueError(f"{order - 1} strengths are needed for order {order}, not {len(strengths)}")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(trained, F.lit(True)).alias("train")
    )
    chunks = staged(_chunks(rows, chunk_bytes), "lm-chunks")
    n_chunks = chunks.count()
    bits = hops(n_chunks, radix_bits)
    totals = _corpus_counts(_gram_counts(chunks, order, bits[0]), n_chunks, bits, bits[0])
    n_tokens, n_words = _seen(totals.where("unit = -1 and length = 1").select("totals"))

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: chunk.column(c)[0].as_py() for c in ("ids", "lengths", "texts")}
        grams = Grams(_texts(row), order)
        found: dict[int, list] = defaultdict(list)
        for answer in sorted(answers.to_pylist(), key=lambda a: (a["length"], a["shard"])):
            found[answer["length"]].append(_unpack(answer["totals"], "<i8"))
        counts = {n: np.concatenate(found.pop(n)) for n in sorted(found)}
        automaton = BackoffAutomaton(grams, counts, n_tokens, n_words, strengths)
        del counts
        log_p, base = automaton.traverse(), automaton.base[grams.at[1]]
        known = automaton.seen[1][grams.at[1]].astype(np.int64)
        total = lambda x: np.add.reduceat(x, grams.first)
        return pa.table({
            "id": pa.array(row["ids"], chunk.schema.field("ids").type.value_type), "n_tokens": grams.sizes,
            "n_known": total(known), "train_tokens": np.full(len(grams.sizes), n_tokens, dtype=np.int64),
            "base_score": total(base), "score": total(log_p),
        })

    kind = rows.schema["id"].dataType.simpleString()
    scored = chunks.select("chunk", "ids", "lengths", "texts").groupBy("chunk").cogroup(
        totals.where("unit >= 0").withColumnRenamed("unit", "chunk").groupBy("chunk")
    ).applyInArrow(score, _SCORE_SCHEMA.format(id=kind))
    return scored.withColumnRenamed("id", id_col)


def _seen(rows: DataFrame) -> tuple[int, int]:
    """N and V, summed by Spark over the shards."""
    number = lambda at: F.expr(f"cast(conv(hex(substring(totals, {at}, 8)), 16, 10) as bigint)")
    row = rows.agg(F.sum(number(1)), F.sum(number(9))).first()
    return int(row[0] or 0), int(row[1] or 0)
