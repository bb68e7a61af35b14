"""SimHash near-dedup against brute force over all pairs."""

import random

import numpy as np
import xxhash

from logsieve.llm import simhash
from logsieve.llm.simhash import (
    band_masks,
    fingerprint,
    hamming_links,
    keep_one_of_each,
    near_pairs,
    simhash_near_dups,
)


def brute_components(ids, fps, max_bits=3):
    fps = np.array(fps, dtype=np.uint64)
    root = dict.fromkeys(ids)
    for start in sorted(root):
        if root[start] is not None:
            continue
        todo, root[start] = [start], start
        while todo:
            x = todo.pop()
            for k in [k for k, i in enumerate(ids) if i == x]:
                for j in np.flatnonzero(np.bitwise_count(fps ^ fps[k]) <= max_bits):
                    if root[ids[j]] is None:
                        root[ids[j]] = start
                        todo.append(ids[j])
    return root


def test_fingerprint_is_the_majority_of_shingle_hashes():
    text = "One two\tTHREE four two  three\nfour"
    words = ["one", "two", "three", "four", "two", "three", "four"]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), seed=42) for i in range(5)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert fingerprint(text) == want
    assert fingerprint("one TWO") == xxhash.xxh64_intdigest("one two", seed=42)
    assert fingerprint(None) == fingerprint("") == fingerprint(" \n\t") == 0
    assert fingerprint("É a b") != fingerprint("é a b")  # only A-Z is lower-cased


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert fingerprint(text) == whole


def test_masks_lose_no_pair():
    rnd = random.Random(3)
    for distinct, tables in ((10, 4), (10**8, 10), (10**11, 20)):
        masks = band_masks(3, distinct)
        assert len(masks) == tables
        for _ in range(300):
            a = rnd.getrandbits(64)
            b = a
            for bit in rnd.sample(range(64), 3):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_pivot_tables_keep_exactly_the_near_pairs():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 60, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64))
    i, j = (x.ravel() for x in np.indices((60, 60)))
    got = set(zip(*near_pairs(a, b, i, j, 3)))
    assert got == {(x, y) for x, y in zip(i, j) if int(a[x] ^ b[y]).bit_count() <= 3}


def test_links_with_large_buckets(spark, monkeypatch):
    # One tight cluster far above the block size: split buckets, forest only.
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    fps = {base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)}
    fps |= {int(x) for x in rng.integers(0, 2**63, 300)}
    monkeypatch.setattr(simhash, "BLOCK", 64)
    rows = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    links = hamming_links(rows).collect()
    assert all(int(np.bitwise_count(np.uint64((r.a ^ r.b) % 2**64))) <= 64 for r in links)
    assert len(links) < 40 * len(fps)  # forests, not all pairs
    groups = {}
    for r in links:
        groups.setdefault(r.a, set()).add(r.b)
    ids = [r[0] for r in rows.collect()]
    want = brute_components(ids, [i % 2**64 for i in ids])
    from logsieve.llm.components import connected_components

    got = {r.node: r.component for r in connected_components(hamming_links(rows)).collect()}
    assert {i: got.get(i, i) for i in ids} == want


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, ID int")


def test_operator_against_brute_force(spark):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(150):
        text = " ".join(rnd.choices(words, k=rnd.choice([1, 2, 5, 120])))
        rows.append((i, text, "clash", 1))
        if i % 3 == 0:  # a near copy: one word changed
            parts = text.split()
            parts[rnd.randrange(len(parts))] = "changed"
            rows.append((1000 + i, " ".join(parts), None, 2))
        if i % 7 == 0:
            rows.append((2000 + i, text.upper(), None, None))
    rows += [(9001, None, None, None), (9000, "", None, None), (9002, " \n", None, None), (3, rows[5][1], None, None)]
    got = simhash_near_dups(_docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    fps = [fingerprint(r[1]) for r in rows]
    want = brute_components([r[0] for r in rows], fps)
    # A repeated id names one document with two texts; its rows may differ.
    unique = {r[0] for r in rows} - {3}
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id in unique and want[r.doc_id] in unique)
    by_id = {r.doc_id: r for r in got}
    assert by_id[9001].fingerprint == "0" * 16 and by_id[9001].component_id == 9000
    assert by_id[7].fingerprint == f"{fingerprint(rows[[r[0] for r in rows].index(7)][1]):016x}"


def test_empty_table_null_ids_and_repeats(spark):
    assert simhash_near_dups(_docs(spark, [])).count() == 0
    rows = [(None, "a b c d", None, 1), (5, "a b c d", None, 1), (5, "a b c d", None, 1), (8, "A B c d", None, 1),
            (None, "only null id", None, 1)]
    got = [tuple(r)[::2] for r in simhash_near_dups(_docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 5), (5, 5), (5, 5), (8, 5), (None, None)], key=str)


def test_keep_one_of_each(spark):
    rows = [(4, "a b c d", "x", 1), (2, "a b c D", "y", 1), (2, "a b c D", "z", 1), (9, "q r s t", "x", 1), (None, "a b c d", "x", 1)]
    docs = _docs(spark, rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 9, None]


def test_keep_one_of_each_where_an_id_names_several_texts(spark):
    near = " ".join(f"w{i}" for i in range(400))
    rows = [
        (3, near, "a", 1), (7, near.upper(), "b", 1), (7, "a text of its own", "c", 1),  # 7: a copy of 3, and unique
        (8, "first text under eight", "d", 1), (8, "second text, not linked to it", "e", 1),
        (8, "second text, not linked to it", "f", 1), (None, "no id here", "g", 1), (None, "no id here", "h", 1),
        (None, "NO id here", "i", 1), (None, "another without id", "j", 1), (None, None, "k", 1), (None, "", "l", 1),
    ]
    kept = sorted(r.fingerprint for r in keep_one_of_each(_docs(spark, rows)).collect())
    assert [k for k in kept if k in "abcd"] == ["a", "c", "d"]
    assert len([k for k in kept if k in "ef"]) == 1
    assert len([k for k in kept if k in "ghi"]) == 1 and "j" in kept
    assert len([k for k in kept if k in "kl"]) == 1 and len(kept) == 7
