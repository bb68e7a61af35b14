"""Token-id shards as wavelet matrices: one compressed file column per shard."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsieve.llm.common import each

#: Token ids of a shard, unless its last document is longer.
SHARD_TOKENS = 1 << 19
#: Positions between two entries of the rank directory.
RANK_STEP = 512
#: Shards up to which their starts are broadcast to the readers.
BROADCAST_SHARDS = 1 << 20
#: Distinct pieces of a generation that a worker remembers the ids of.
PIECES = 250_000
#: Of these, how many it keeps when its task has ended.
KEPT_PIECES = 50_000
#: Bytes of text cut as one array, unless a single text is longer.
SLICE_BYTES = 2 << 20
#: Bytes of pieces and their ids that a worker keeps from slice to slice.
KEPT_BYTES = 16 << 20
#: Pieces that one call of the BPE model merges.
MODEL_PIECES = 64

_MAGIC = b"WMTX"


class WaveletMatrix:
    """Succinct bit planes of a sequence of ids: access, rank and select.

    Plane 0 holds the top bit of every id in order. Each next plane holds the
    next bit, of the ids as stably sorted by the bit before (zeros first). A
    directory of ones per RANK_STEP positions makes rank one lookup and a
    count of a few bytes; select is a binary search over rank.
    """

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes
        self.bits = len(planes)
        self._directory = [
            np.r_[0, np.cumsum(np.add.reduceat(np.bitwise_count(p), np.arange(0, len(p), RANK_STEP // 8), dtype=np.int64))]
            if len(p) else np.zeros(1, dtype=np.int64)
            for p in planes
        ]
        self.zeros = [n - int(d[-1]) for d in self._directory]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n, now, planes = len(ids), np.asarray(ids, dtype=np.uint32), []
        bits = max(1, int(now.max()).bit_length()) if n else 0
        now = now.astype(np.uint16) if bits <= 16 else now
        for level in range(bits - 1, -1, -1):
            bit = now & now.dtype.type(1 << level) != 0
            planes.append(np.packbits(bit))
            now = np.concatenate([now.compress(~bit), now.compress(bit)])
        return cls(n, planes)

    def rank1(self, plane: int, at: int) -> int:
        """Ones of a plane before position `at`."""
        bits, block = self.planes[plane], at // RANK_STEP
        first, whole = block * RANK_STEP // 8, at // 8
        ones = int(self._directory[plane][block]) + int(np.bitwise_count(bits[first:whole]).sum())
        return ones + (int(bits[whole]) >> (8 - at % 8)).bit_count() if at % 8 else ones

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at // 8]) >> (7 - at % 8) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        out = 0
        for p in range(self.bits):
            bit, ones = self._bit(p, at), self.rank1(p, at)
            at = self.zeros[p] + ones if bit else at - ones
            out = out << 1 | bit
        return out

    def _interval(self, token: int, at: int) -> tuple[int, int]:
        """Where, below the last plane, the copies of `token` before `at` lie."""
        first, last = 0, at
        for p in range(self.bits):
            a, b = self.rank1(p, first), self.rank1(p, last)
            if token >> (self.bits - 1 - p) & 1:
                first, last = self.zeros[p] + a, self.zeros[p] + b
            else:
                first, last = first - a, last - b
        return first, last

    def rank(self, token: int, at: int | None = None) -> int:
        """How often `token` occurs before position `at` (the end if None)."""
        if token < 0 or token >> self.bits:
            return 0
        first, last = self._interval(token, self.n if at is None else at)
        return last - first

    def select(self, token: int, k: int) -> int:
        """The position of the k-th `token`, counted from 0."""
        if not 0 <= k < self.rank(token):
            raise IndexError(k)
        at = self._interval(token, 0)[0] + k
        for p in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - p) & 1
            at = self._select_bit(p, one, at - self.zeros[p] if one else at)
        return at

    def _select_bit(self, plane: int, one: int, k: int) -> int:
        low, high = 0, self.n - 1
        while low < high:
            mid = (low + high) // 2
            ones = self.rank1(plane, mid + 1)
            if (ones if one else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def occurrences(self, token: int) -> list[int]:
        """Every position of `token`, in order."""
        return [self.select(token, k) for k in range(self.rank(token))]

    def to_array(self) -> np.ndarray:
        """All ids in order, by undoing the planes from the last to the first."""
        now = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for p in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[p], count=self.n).view(bool)
            before = np.empty_like(now)
            before[np.flatnonzero(~bit)] = now[: self.zeros[p]]
            before[np.flatnonzero(bit)] = now[self.zeros[p] :] | now.dtype.type(1 << (self.bits - 1 - p))
            now = before
        return now.astype(np.uint32)

    def to_bytes(self) -> bytes:
        """Header, then every plane, compressed with zstd."""
        packed = zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in self.planes))
        return _MAGIC + struct.pack("<QB", self.n, self.bits) + packed

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        if raw[:4] != _MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QB", raw, 4)
        width = -(-n // 8)
        body = zstandard.ZstdDecompressor().decompress(raw[13:], max_output_size=width * bits or 1)
        return cls(n, [np.frombuffer(body, np.uint8, width, p * width) for p in range(bits)])


# White space as Unicode defines it; a piece is a run without it, with at most
# one space before. A word before white space or any other ASCII character is
# cut there, as no piece of byte-level BPE goes on from letters to those.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ʯ"
_PIECE = re.compile(
    f" ?[{_LETTERS}]+(?=[\0-@[-`{{-\x7f{_WHITE}]|\\Z)| ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


# The same pieces of a text of ASCII characters alone, where nothing but a
# letter goes on a word.
_ASCII_PIECE = re.compile(r" ?[A-Za-z]+| ?[^\t-\r ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_WORD = re.compile(f" ?[{_LETTERS}]+")
_SPACE_WRITTEN = "\u0120"  # how byte-level BPE writes a space
_TOKEN_ID = attrgetter("id")
_PACK = [struct.Struct(f"<{n}I").pack for n in range(17)]


def _cut(text: str) -> list[str]:
    return (_ASCII_PIECE if text.isascii() else _PIECE).findall(text)


# The kinds of bytes by which whole arrays of texts are cut. The bytes of a
# wide white space and of an accented letter are all of one kind; what is known
# of no other character is that it is not white.
_SPACE, _BLANK, _WIDE, _LETTER, _ACCENT, _DIGIT, _QUOTE, _SIGN, _OTHER = range(9)
_WHITE_KINDS, _LETTER_KINDS = (_SPACE, _BLANK, _WIDE), (_LETTER, _ACCENT)
# Where two bytes that meet make a cut: between them, before the white space
# that is the first, or, if that is wide, before its first byte.
_BETWEEN, _BEFORE, _BEFORE_WIDE = 1, 2, 4


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[:128] = _SIGN
    kinds[ord("\t") : ord("\r") + 1] = _BLANK
    kinds[[ord(" "), ord("'")]] = _SPACE, _QUOTE
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[ord("A") : ord("Z") + 1] = kinds[ord("a") : ord("z") + 1] = _LETTER
    return kinds


def _border(a: int, b: int) -> int:
    """The cuts that a byte of kind `a` before one of kind `b` makes. Of a run
    of white space before another character the last is a piece of its own, or
    a space at the head of the next piece; a quote may go on with letters."""
    if a in _WHITE_KINDS:
        return 0 if b in _WHITE_KINDS else {_SPACE: _BEFORE, _BLANK: _BETWEEN | _BEFORE, _WIDE: _BETWEEN | _BEFORE_WIDE}[a]
    if b in _WHITE_KINDS:
        return _BETWEEN
    after = {
        _LETTER: (_DIGIT, _QUOTE, _SIGN), _ACCENT: (_DIGIT, _QUOTE, _SIGN), _DIGIT: (*_LETTER_KINDS, _QUOTE, _SIGN),
        _SIGN: (*_LETTER_KINDS, _DIGIT), _QUOTE: (_DIGIT,), _OTHER: (),
    }
    return _BETWEEN if b in after[a] else 0


_KINDS = _byte_kinds()
_BORDERS = np.array([_border(a, b) if max(a, b) <= _OTHER else 0 for a in range(16) for b in range(16)], dtype=np.uint8)


def _kinds(raw: np.ndarray) -> np.ndarray:
    """The kind of every byte of UTF-8 texts."""
    kinds = _KINDS[raw]
    if not len(raw) or raw.max() < 0x80:
        return kinds
    at = np.flatnonzero((raw >= 0xC3) & (raw <= 0xCA))  # À to ʯ, less the signs × and ÷
    lead, second = raw[at], raw[at + 1]
    at = at[~((lead == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (lead == 0xCA) & (second > 0xAF))]
    kinds[at] = kinds[at + 1] = _ACCENT
    at = np.flatnonzero(raw == 0xC2)
    at = at[(raw[at + 1] == 0x85) | (raw[at + 1] == 0xA0)]
    kinds[at] = kinds[at + 1] = _WIDE
    at = np.flatnonzero((raw >= 0xE1) & (raw <= 0xE3))
    code = (raw[at].astype(np.int32) & 15) << 12 | (raw[at + 1].astype(np.int32) & 63) << 6 | raw[at + 2] & 63
    at = at[np.isin(code, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
    kinds[at] = kinds[at + 1] = kinds[at + 2] = _WIDE
    return kinds


def _cuts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin that lie side by side in `raw`, each
    from one of `starts` on. As finely as bytes side by side can tell, always
    where the byte-level pre-tokenizer cuts too."""
    kinds, border = _kinds(raw), np.zeros(len(raw) + 1, dtype=np.uint8)
    np.take(_BORDERS, kinds[:-1] << 4 | kinds[1:], out=border[1:-1])
    border[starts] = _BETWEEN
    cut = border[:-1] & _BETWEEN | border[1:] >> 1 & 1
    at = np.flatnonzero(border & _BEFORE_WIDE)
    cut[np.where(raw[at - 2] == 0xC2, at - 2, at - 3)] = 1
    return np.flatnonzero(cut)


def _byte_alphabet() -> dict[int, str]:
    """How byte-level BPE writes each byte: printable Latin-1 as itself, the
    others, in order, as the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


class _Pieces(dict):
    """Ids by piece: looks up what it holds, encodes the rest once. It keeps
    two generations of `PIECES`, so that what is still used stays."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        if (found := self.older.get(piece)) is None:
            found = self.encode(piece)
        if len(self) >= PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found

    def trim(self) -> None:
        """Keep the pieces met first, which are mostly the frequent ones."""
        kept = dict(islice(self.items(), KEPT_PIECES))
        self.older = {}
        self.clear()
        self.update(kept)


class Encoder:
    """Ids of whole texts by the `tokenizers` library, as little-endian u32.

    A byte-level BPE tokenizer splits at white space before merging, so equal
    pieces between two cuts have equal ids: a text is cut there and each
    distinct piece is encoded by the library once per worker, a piece that
    is one word by the library's BPE model itself. The strings of added
    tokens are cut out first and give those tokens' ids; with
    `special_as_text` the special ones among them are ordinary text. Any
    other tokenizer encodes the text as one piece.

    `encode_all` cuts a column of texts as one array of bytes and has the
    library encode what it has not met, words many at a time: the model's
    merges never take in a byte that no token holds but its own, so words
    with such a byte between them are merged each by itself.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model, cut = self.tokenizer.model, self.tokenizer.pre_tokenizer
        added = {
            i: t for i, t in self.tokenizer.get_added_tokens_decoder().items()
            if t.content and not (special_as_text and t.special)
        }
        self.by_piece = (
            type(self.model).__name__ == "BPE" and type(cut).__name__ == "ByteLevel"
            and self.tokenizer.normalizer is None and not cut.add_prefix_space and cut.use_regex
            and not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
            and len({t.normalized for t in added.values()}) < 2
        )
        self.added = {t.content: struct.pack("<I", i) for i, t in added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self.alphabet = _byte_alphabet()
        self.pieces = _Pieces(self._piece)
        self._forget()
        self.mark = self._unmerged_byte() if self.by_piece else None

    def _forget(self) -> None:
        self.known, self.known_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _unmerged_byte(self) -> int | None:
        """The id of the byte 0xFF, which no text holds, if the model always
        leaves it by itself."""
        model, written = self.model, self.alphabet[0xFF]
        plain = not (model.dropout or model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix)
        vocabulary = self.tokenizer.get_vocab()
        return vocabulary[written] if plain and [t for t in vocabulary if written in t] == [written] else None

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.removeprefix(" ").isalpha():
            written = _SPACE_WRITTEN + piece[1:] if piece[0] == " " else piece
        elif _WORD.fullmatch(piece):
            written = piece.encode().decode("latin-1").translate(self.alphabet)
        else:
            return self._ids(piece)
        ids = list(map(_TOKEN_ID, self.model.tokenize(written)))
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_piece:
            return self._ids(text)
        if not any(content in text for content in self.added):
            return b"".join(map(self.pieces.__getitem__, _cut(text)))
        out = []
        for k, part in enumerate(self.at_added.split(text)):
            out += [self.added[part]] if k % 2 else map(self.pieces.__getitem__, _cut(part))
        return b"".join(out)

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column, in order; a null text is empty."""
        if self.mark is None:
            yield from map(self.encode, each(texts))
            return
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        texts.validate(full=True)
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, "right")) - 1)
            part = texts[first:last]
            special = np.zeros(len(part), dtype=bool)
            for content in self.added:
                special |= pc.match_substring(part, content).to_numpy(zero_copy_only=False)
            for k, ids in enumerate(self._slice(part, at[first : last + 1])):
                yield self.encode(part[k].as_py()) if special[k] else ids
            first = last

    def _slice(self, texts: pa.Array, at: np.ndarray) -> Iterator[bytes]:
        """The ids of each text; `at` holds where they begin in their buffer and
        where the last ends. Strings of added tokens are read as text."""
        if at[0] == at[-1]:
            return iter([b""] * len(texts))
        raw, starts = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]
        cuts = _cuts(raw, starts)
        ends = np.append(cuts, len(raw))
        pieces = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(ends), pa.py_buffer(raw))
        found = pc.index_in(pieces, value_set=self.known)
        missing = pc.is_null(found)
        places = pc.fill_null(found, 0).to_numpy(zero_copy_only=False)
        if found.null_count:
            unseen = pieces.filter(missing).dictionary_encode()
            places = places.copy()
            places[missing.to_numpy(zero_copy_only=False)] = self._learn(unseen.dictionary)[unseen.indices.to_numpy()]
        ids = self.known_ids.take(pa.array(places))
        if self.known.nbytes + self.known_ids.nbytes > KEPT_BYTES:  # what this slice used stays
            used = pa.array(np.unique(places))
            self.known, self.known_ids = self.known.take(used), self.known_ids.take(used)
            if self.known.nbytes + self.known_ids.nbytes > KEPT_BYTES:
                self._forget()
        bounds = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(ends, starts)].tolist()
        data = memoryview(ids.buffers()[2])
        return (bytes(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:]))

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Encode unseen pieces; where each now stands among the known ones."""
        at = np.frombuffer(pieces.buffers()[1], np.int64)[: len(pieces) + 1]
        kinds = _kinds(np.frombuffer(pieces.buffers()[2], np.uint8)[: at[-1]])
        body = np.diff(at) - (kinds[at[:-1]] == _SPACE)
        one = np.zeros(len(pieces), dtype=bool)
        for alike in (_LETTER_KINDS, (_DIGIT,), (_QUOTE, _SIGN)):
            one |= np.add.reduceat(np.isin(kinds, alike), at[:-1], dtype=np.int64) == body
        one &= body > 0
        words, others = pieces.filter(pa.array(one)), pieces.filter(pa.array(~one))
        others_ids = pa.array([self._ids(p) for p in others.to_pylist()], pa.large_binary())
        places = np.empty(len(pieces), dtype=np.int32)
        places[np.r_[np.flatnonzero(one), np.flatnonzero(~one)]] = len(self.known) + np.arange(len(pieces))
        self.known = pa.concat_arrays([self.known, words, others])
        self.known_ids = pa.concat_arrays([self.known_ids, self._merged(words), others_ids])
        return places

    def _merged(self, words: pa.Array) -> pa.Array:
        """The ids of pieces that the pre-tokenizer leaves whole, by the model."""
        raw, tokens = words.cast(pa.large_binary()).to_pylist(), []
        for k in range(0, len(raw), MODEL_PIECES):
            written = b"".join(p + b"\xff" for p in raw[k : k + MODEL_PIECES]).decode("latin-1").translate(self.alphabet)
            tokens += map(_TOKEN_ID, self.model.tokenize(written))
        ids = np.array(tokens, dtype="<u4")
        marks = np.flatnonzero(ids == self.mark)
        at = np.r_[0, marks - np.arange(len(marks))].astype(np.int64) * 4
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(raw), [None, pa.py_buffer(at), pa.py_buffer(ids[ids != self.mark])])


def _encoder(path: str, made: dict[str, Encoder] = {}) -> Encoder:  # noqa: B006  one per worker process
    if path not in made:
        made[path] = Encoder(path, special_as_text=False)
    return made[path]


def _tokenizer_path(tokenizer: str) -> str:
    if "/" in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


SHARD_SCHEMA = (
    "part long, seq long, n_tokens long, n_docs long, first_id {id}, last_id {id}, "
    "ids array<{id}>, lengths binary, wavelet binary"
)


def write_token_shards(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode every whole text and write the shards under `path`.

    Documents are dealt into ranges of ascending id (null ids first, repeated
    ids side by side); each task sorts its range and cuts it into shards of
    about `shard_tokens` ids, one row each: the document ids, the documents'
    lengths, and the wavelet matrix of their ids, each document closed by
    `end_id`. A null text is empty and gives the end id alone. `path` is
    written by Spark, so it may be any store that Spark can reach. Other
    columns are ignored; an empty table writes no shard.

    `tokenizer` is a file's path, or the name of one of the public files;
    every executor opens its own. The ids are those of the library's
    `encode(text, add_special_tokens=False)`, so the string of an added token
    in a text is that token.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ranges = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    ranges = ranges.withColumn("part", F.spark_partition_id().cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seq = _encoder(_tokenizer_path(tokenizer)), 0
        end = struct.pack("<I", end_id)
        ids, lengths, tokens, part, held, id_type = [], [], [], 0, 0, pa.int64()

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(tokens), "<u4"))
            sizes = zstandard.ZstdCompressor(level=1).compress(np.array(lengths, dtype="<u4").tobytes())
            return pa.RecordBatch.from_pydict({
                "part": [part], "seq": [seq], "n_tokens": [matrix.n], "n_docs": [len(ids)],
                "first_id": pa.array(ids[:1], id_type), "last_id": pa.array(ids[-1:], id_type),
                "ids": pa.array([ids], pa.list_(id_type)), "lengths": [sizes], "wavelet": [matrix.to_bytes()],
            })

        for batch in batches:
            id_type = batch.column("id").type
            encoded = own.encode_all(batch.column("text"))
            for name, raw, part in zip(each(batch.column("id")), encoded, each(batch.column("part"))):
                tokens += [raw, end]
                ids.append(name)
                lengths.append(len(raw) // 4 + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield shard()
                    ids, lengths, tokens, held, seq = [], [], [], 0, seq + 1
        if ids:
            yield shard()
        own.pieces.trim()
        pa.default_memory_pool().release_unused()

    ranges.mapInArrow(run, SHARD_SCHEMA.format(id=kind)).write.option("compression", "uncompressed").parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """`shards` with `start`, the ids in all shards before each.

    The totals of the parts are summed over parts, then the shards of a part
    over that part, so no task sees more than one part's shards or one row
    per part.
    """
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    sums = shards.select("part", "seq", F.coalesce(inside, F.lit(0)).alias("inside")).join(parts, "part")
    return sums.select("part", "seq", (F.col("base") + F.col("inside")).alias("start"))


def read_token_shards(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of every document in the shards,
    decoded from the wavelet matrices."""
    shards = spark.read.parquet(path)
    kind = shards.schema["first_id"].dataType.simpleString()
    starts = shard_starts(shards.select("part", "seq", "n_tokens"))
    if shards.count() <= BROADCAST_SHARDS:  # three longs each; beyond it the shards are shuffled
        starts = F.broadcast(starts)
    rows = shards.join(starts, ["part", "seq"]).select("ids", "lengths", "wavelet", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            id_type = batch.column("ids").type.value_type
            for k in range(batch.num_rows):
                ids, lengths, wavelet, start = (batch.column(c)[k].as_py() for c in range(4))
                sizes = np.frombuffer(unpack.decompress(lengths, max_output_size=4 * len(ids)), "<u4").astype(np.int64)
                tokens = WaveletMatrix.from_bytes(wavelet).to_array().astype("<u4")
                at = np.r_[0, np.cumsum(sizes)]
                crc = [zlib.crc32(tokens[a:b]) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(ids, id_type), "start": start + at[:-1], "n_tokens": sizes,
                    "ids_crc32": pa.array(crc, pa.int64()),
                })

    out = rows.mapInArrow(run, f"id {kind}, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


def token_occurrences(spark, path: str, token: int) -> DataFrame:
    """(position) of every `token` over all shards: its place among the ids of
    the whole corpus, found by rank and select without decoding a shard."""
    shards = spark.read.parquet(path)
    starts = shard_starts(shards.select("part", "seq", "n_tokens"))
    if shards.count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    rows = shards.join(starts, ["part", "seq"]).select("wavelet", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start = batch.column("start")[k].as_py()
                found = WaveletMatrix.from_bytes(batch.column("wavelet")[k].as_py()).occurrences(token)
                yield pa.RecordBatch.from_pydict({"position": pa.array([start + at for at in found], pa.int64())})

    return rows.mapInArrow(run, "position long")


def token_counts(spark, path: str, tokens: list[int]) -> DataFrame:
    """(token, n) of each of `tokens` over all shards, by rank."""
    shards = spark.read.parquet(path).select("wavelet")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("wavelet"):
                matrix = WaveletMatrix.from_bytes(raw.as_py())
                counts = [matrix.rank(t) for t in tokens]
                yield pa.RecordBatch.from_pydict({"token": pa.array(tokens, pa.int64()), "n": pa.array(counts, pa.int64())})

    return shards.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
