"""Epsilon grid order join against all pairs."""

import numpy as np
import pytest

from logsieve.llm.epsjoin import embedding_near_dups, near_blocks, valid_vector


def brute(rows, min_cosine=0.98):
    ids = [r[0] for r in rows]
    ok, unit = [], []
    for _, v, label in rows:
        x = np.array([np.nan if c is None else c for c in v] if v else [np.nan], dtype=np.float64)
        good = label is not None and np.isfinite(x).all() and bool(np.any(x))
        ok.append(good)
        unit.append(x / np.linalg.norm(x) if good else None)
    links = {k: [] for k in range(len(ids))}
    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= min_cosine:
                links[i].append(j)
                links[j].append(i)
    out = {}
    for start in sorted(range(len(ids)), key=lambda k: ids[k]):
        if start in out:
            continue
        todo = [start]
        out[start] = ids[start]
        while todo:
            for j in links[todo.pop()]:
                if j not in out:
                    out[j] = ids[start]
                    todo.append(j)
    return sorted((ids[k], len(links[k]), out[k], ids[k] == out[k]) for k in range(len(ids)))


def _rows(seed, n=220, dim=16):
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(12, dim))
    for i in range(n):
        kind = rng.integers(0, 4)
        c = centres[rng.integers(0, 12)]
        v = rng.normal(size=dim) if kind == 0 else c + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.2])
        rows.append((int(i), np.float32(v * rng.choice([1, 3])).tolist(), int(rng.integers(0, 3))))
    hot = np.float32(centres[0])  # a third of all rows in one tight group, and copies
    rows += [(1000 + i, np.float32(hot + rng.normal(size=dim) * 0.05).tolist(), 1) for i in range(n // 3)]
    rows += [(2000 + i, hot.tolist(), 1) for i in range(30)]
    rows += [
        (3000, None, 1), (3001, [], 1), (3002, [0.0] * dim, 1), (3003, [None] + [1.0] * (dim - 1), 1),
        (3004, [float("nan")] + [1.0] * (dim - 1), 1), (3005, [float("inf")] * dim, 1), (3006, hot.tolist(), None),
        (3007, [1.0, 2.0], 1), (3008, [2.0, 4.0], 1), (3009, [5.0], 2),
    ]
    return rows


@pytest.mark.parametrize(("seed", "block", "dimensions"), [(0, 512, 8), (1, 16, 4), (2, 7, 2)])
def test_against_all_pairs(spark, seed, block, dimensions):
    rows = _rows(seed)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = embedding_near_dups(frame, block=block, dimensions=dimensions)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_null_and_repeated_ids_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (6, [1.0, 0.01], 1)]
    got = sorted((tuple(r) for r in embedding_near_dups(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (4, 2, 4, True), (4, 2, 4, True), (6, 2, 4, False)], key=str)
    assert embedding_near_dups(spark.createDataFrame([], schema)).count() == 0
    assert embedding_near_dups(spark.createDataFrame([(1, None, 1)], schema)).first().n_links == 0


def test_distant_blocks_are_skipped(spark):
    boxes = [(k, "x", 2, [float(k), 0.0], [k + 0.5, 0.0]) for k in range(40)]
    blocks = spark.createDataFrame(boxes, "block long, label string, dim int, low array<double>, high array<double>")
    pairs = {tuple(r) for r in near_blocks(blocks, 0.6, 2, fanout=3).collect()}
    assert pairs == {(a, b) for a in range(40) for b in range(a, 40) if max(0, b - a - 0.5) <= 0.6}


def test_validity(spark):
    rows = [([1.0],), ([0.0],), ([],), (None,), ([float("nan")],), ([None, 1.0],), ([-float("inf")],)]
    frame = spark.createDataFrame(rows, "v array<float>")
    assert [r[0] for r in frame.select(valid_vector(frame.v)).collect()] == [True] + [False] * 6
