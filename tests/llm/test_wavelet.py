"""Wavelet matrix shards: rank, select and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from logsieve.llm import wavelet
from logsieve.llm.wavelet import (
    _ASCII_PIECE,
    _PIECE,
    Encoder,
    WaveletMatrix,
    read_token_shards,
    token_counts,
    token_occurrences,
    write_token_shards,
)
from logsieve.sources import scratch_path


@pytest.mark.parametrize("ids", [
    [], [0], [0, 0, 0], [5], [50256, 0, 7, 7, 1, 50256], list(range(700)) * 3,
    np.random.default_rng(0).integers(0, 300, 2500).tolist(),
])
def test_matrix_against_a_list(ids):
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(np.array(ids, dtype=np.uint32)).to_bytes())
    assert m.to_array().tolist() == ids
    rnd = random.Random(1)
    for at in rnd.sample(range(len(ids)), min(60, len(ids))):
        assert m.access(at) == ids[at]
        assert m.rank(ids[at], at) == ids[:at].count(ids[at])
    for token in {*ids[:5], 1, 299, 70000}:
        places = [k for k, x in enumerate(ids) if x == token]
        assert m.rank(token) == len(places) and m.occurrences(token) == places
    with pytest.raises(IndexError):
        m.access(len(ids))
    with pytest.raises(IndexError):
        m.select(3, ids.count(3))


def test_encoder_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    encoder, rnd = Encoder(path), random.Random(4)
    assert encoder.by_piece
    letters = "aZé ñ.,'sтя文 \n\t  \x1c\x1f9½Ⅷ!?😀_ʰǅªº|<>　"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(1, 15))) for _ in range(3000)]
    texts += ["don't we'll  <|endoftext|> x", " leading", "trailing  ", "a\n\n b \n c"]
    for text in texts:
        want = np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.encode(text) == want, repr(text)
    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.by_piece
    assert other.encode("Hello there") == np.array(
        other.tokenizer.encode("Hello there", add_special_tokens=False).ids, dtype="<u4").tobytes()


def _expected(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for name, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_shards_round_trip(spark):
    rows = [(k, f"Document {k}! " * (k % 40)) for k in range(120)] + [(500, None), (501, ""), (502, "x" * 50_000)]
    random.Random(0).shuffle(rows)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, start string").repartition(5)
    for tokens in (1 << 19, 200):
        path = scratch_path(spark, "shards")
        write_token_shards(docs, path, shard_tokens=tokens)
        got = sorted(tuple(r) for r in read_token_shards(spark, path).collect())
        assert got == _expected(sorted(rows))
    # Counting and lookup go through the wavelet matrices, over all shards.
    every = [i for n, t in sorted(rows) for i in [*Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(
        t or "", add_special_tokens=False).ids, 0]]
    rare = max(every)
    places = sorted(r.position for r in token_occurrences(spark, path, rare).collect())
    assert places == [k for k, i in enumerate(every) if i == rare]
    counts = {r.token: r.n for r in token_counts(spark, path, [0, rare, 49999]).collect()}
    assert counts == {0: every.count(0), rare: len(places), 49999: every.count(49999)}
    # Tokens are reached from one shard's file alone.
    shard = spark.read.parquet(path).orderBy("part", "seq").first()
    assert WaveletMatrix.from_bytes(shard.wavelet).rank(0) >= shard.n_docs


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "first"), (3, "b"), (3, "a"), (3, "a"), (2**60 + 1, "large id")]
    path = scratch_path(spark, "shards")
    write_token_shards(spark.createDataFrame(rows, "doc_id long, text string"), path)
    got = sorted((tuple(r) for r in read_token_shards(spark, path).collect()), key=lambda r: r[1])
    assert got == _expected([(None, "first"), (3, "a"), (3, "a"), (3, "b"), (2**60 + 1, "large id")])
    path = scratch_path(spark, "shards")
    write_token_shards(spark.createDataFrame([], "doc_id long, text string"), path)
    assert read_token_shards(spark, path).count() == 0


def test_special_token_strings_as_the_plain_call_reads_them(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder, rnd = Tokenizer.from_file(path), Encoder(path, special_as_text=False), random.Random(6)
    assert encoder.by_piece
    special = "<|endoftext|>"
    assert plain.token_to_id(special) in plain.encode(f"a {special} b", add_special_tokens=False).ids
    texts = [f"a {special} b", special, f"{special}{special}", f"x  {special}  y", f"<|{special}|>", f"don't{special}'t \n"]
    texts += ["".join(rnd.choices([special, special[:-1], "é", "ab", " ", "\n", "1", "'s", "<", "|>"], k=rnd.randint(1, 12)))
              for _ in range(2000)]
    for text in texts:
        want = np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.encode(text) == want, repr(text)
    rows = list(enumerate(texts[:40]))
    path = scratch_path(spark, "shards")
    write_token_shards(spark.createDataFrame(rows, "doc_id long, text string"), path)
    assert sorted(tuple(r) for r in read_token_shards(spark, path).collect()) == _expected(rows)


def test_ascii_texts_are_cut_and_encoded_alike():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder, rnd = Tokenizer.from_file(path), Encoder(path, special_as_text=False), random.Random(8)
    letters = [*map(chr, range(128)), *"   ab'sTZ", "word", " word", "\r\n", "x" * 300]
    for _ in range(4000):
        text = "".join(rnd.choices(letters, k=rnd.randint(1, 14)))
        assert _ASCII_PIECE.findall(text) == _PIECE.findall(text), repr(text)
        want = np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.encode(text) == want, repr(text)


def _plain(tokenizer, texts):
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


@pytest.mark.parametrize("slice_bytes, kept_bytes", [(2 << 20, 16 << 20), (3000, 60_000), (1, 0)])
def test_columns_are_encoded_like_the_library(monkeypatch, slice_bytes, kept_bytes):
    monkeypatch.setattr(wavelet, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(wavelet, "KEPT_BYTES", kept_bytes)
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder, rnd = Tokenizer.from_file(path), Encoder(path, special_as_text=False), random.Random(9)
    assert encoder.mark is not None
    letters = [*"aZ'st19.,-é×½ª_я文ʰ😀\0\x1c\x7f \n\t", *"\x85\xa0\u1680\u2005\u200b\u2028\u202f\u205f\u3000", "  ", "\r\n",
               "'s", "'ll", " word", "ärger", "<|endoftext|>", "x" * 300]
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 14))) for _ in range(400 if slice_bytes == 1 else 4000)]
    texts += [None, "", " ", "\n", "", None]
    column = pa.array(["cut off", *texts, "cut off"])[1:-1]
    want = _plain(plain, texts)
    assert list(encoder.encode_all(column)) == want
    assert list(encoder.encode_all(column.cast(pa.large_string()))) == want  # from what it has met by now
    assert encoder.known.nbytes + encoder.known_ids.nbytes <= kept_bytes
    assert list(encoder.encode_all(pa.array([None, ""], pa.string()))) == [b"", b""]
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []


def test_columns_hold_any_character():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, encoder = Tokenizer.from_file(path), Encoder(path, special_as_text=False)
    texts = [f"a{c}b {c}.{c}1{c} '{c}s {c}{c} \n{c}" for c in map(chr, range(0x3010))]
    for text, want, got in zip(texts, _plain(plain, texts), encoder.encode_all(pa.array(texts))):
        assert got == want, repr(text)


def test_unseen_words_go_to_the_model_many_at_a_time():
    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, 0

        def tokenize(self, text):
            self.calls += 1
            return self.model.tokenize(text)

    path, rnd = public_tokenizers.path("byte_bpe_50k.json"), random.Random(10)
    plain, encoder = Tokenizer.from_file(path), Encoder(path, special_as_text=False)
    encoder.model = model = Counted(encoder.model)
    words = ["".join(rnd.choices("aeiouéstnr", k=9)) for _ in range(6400)]
    texts = [" ".join(words[k : k + 100]) for k in range(0, len(words), 100)]
    assert list(encoder.encode_all(pa.array(texts))) == _plain(plain, texts)
    assert model.calls <= 101  # a call for each before
    assert list(encoder.encode_all(pa.array(texts))) == _plain(plain, texts)
    assert model.calls <= 101
