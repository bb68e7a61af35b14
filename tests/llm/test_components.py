"""Connected components against a search, on hubs, chains and loops."""

import random

import numpy as np
import pytest

from logsieve.llm.components import connected_components, local_roots


def search(links):
    near = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(None, 2), (3, None)], [(5, 4), (4, 5), (5, 4)],
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)] + [(-7, 150)],
    [tuple(random.Random(k).sample(range(300), 2)) for k in range(180)],
])
def test_against_search(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    rows = connected_components(frame).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == search(links)


def test_local_roots():
    rng = np.random.default_rng(2)
    i, j = rng.integers(0, 80, 50), rng.integers(0, 80, 50)
    want = search(list(zip(i.tolist(), j.tolist())))
    assert local_roots(80, i, j).tolist() == [want.get(k, k) for k in range(80)]
