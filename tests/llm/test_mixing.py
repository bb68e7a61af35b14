"""Mixing: budgets against a recursive allocation, prefixes against a sort."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logsieve.llm import mixing
from logsieve.llm.mixing import leaf_budgets, mix_sources

LEVELS = ["domain", "lang", "source"]


def brute_budgets(leaves, weights, budget, max_epochs):
    """Shares handed down the tree, short children filled one by one."""
    def weight(path):
        return weights.get(path, weights.get(("*", path[-1]), 1) if len(path) > 1 else 1)

    def cap(path):
        if path and weight(path) == 0:
            return 0
        if len(path) == len(LEVELS):
            return leaves[path] * max_epochs
        return sum(cap(c) for c in children(path))

    def children(path):
        return sorted({p[: len(path) + 1] for p in leaves if p[: len(path)] == path})

    out = {}

    def give(path, b):
        if len(path) == len(LEVELS):
            out[path] = b
            return
        open_, left, given = [c for c in children(path) if weight(c) > 0], b, {}
        while True:
            total = sum(weight(c) for c in open_)
            short = [c for c in open_ if cap(c) * total <= left * weight(c)]
            if not short:
                break
            for c in short:
                given[c] = cap(c)
            left -= sum(cap(c) for c in short)
            open_ = [c for c in open_ if c not in short]
        total = done = 0
        total = sum(weight(c) for c in open_)
        for c in open_:
            upto = done + weight(c)
            given[c] = left * upto // total - left * done // total
            done = upto
        for c in children(path):
            give(c, given.get(c, 0))

    give((), min(budget, cap(())))
    return out


def _leaves(seed):
    rnd = random.Random(seed)
    return {(d, la, f"s{s}"): rnd.choice([0, 3, 50, 400, 9000])
            for d in "abc" for la in ("en", "fr") for s in range(rnd.randint(1, 4))}


@pytest.mark.parametrize("seed", range(4))
def test_budgets(spark, seed):
    leaves = _leaves(seed)
    weights = {("a",): 5, ("b",): 2, ("*", "en"): 3, ("a", "fr"): 1, ("b", "en", "s0"): 7, ("*", "s2"): 0}
    frame = spark.createDataFrame([(*k, v, 1) for k, v in leaves.items()], "domain string, lang string, source string, tokens long, docs long")
    for budget in (0, 1, 777, 20_000, 10**9):
        got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(frame, LEVELS, weights, budget, 2).collect()}
        assert got == brute_budgets(leaves, weights, budget, 2)


def _docs(spark, n=400):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.choice([1, 4, 30])), rnd.choice(["en", "fr", None]), rnd.choice(["s0"] * 5 + ["s1", "s2"]), 5) for i in range(n)]
    rows += [(n, None, "en", "s0", 1), (n + 1, "", "en", "s0", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, N_Tokens int")


def test_prefixes_fill_the_budget(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 16)
    rows, docs = _docs(spark)
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    got = mix_sources(docs, levels, {("en",): 3, ("fr",): 1}, budget=3000, max_epochs=3, seed=9)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_tokens", "full_epochs", "take_tokens"]
    out = {r.doc_id: r for r in got.collect()}
    assert sum(r.n_tokens * r.full_epochs + r.take_tokens for r in out.values()) == 3000
    by_leaf = defaultdict(list)
    for i, text, lang, source, _ in rows:
        by_leaf[(lang, source)].append((i, len((text or "").split())))
    for leaf, own in by_leaf.items():
        taken = [out[i] for i, _ in own if i in out]
        budget = sum(r.n_tokens * r.full_epochs + r.take_tokens for r in taken)
        epochs, rest = divmod(budget, sum(t for _, t in own))
        assert epochs <= 3 and {r.full_epochs for r in taken} <= {epochs}
        key = lambda d: hashlib.md5(f"9|{epochs}|{d[0]}".encode()).hexdigest()  # noqa: E731, B023
        for i, tokens in sorted(own, key=key):
            take = min(tokens, rest)
            assert (out[i].take_tokens if i in out else 0) == take
            rest -= take


def test_small_budget_large_budget_and_empty(spark):
    _, docs = _docs(spark, 30)
    levels = {"source": F.col("source")}
    assert mix_sources(docs, levels, {}, budget=0).count() == 0
    every = mix_sources(docs, levels, {}, budget=10**12, max_epochs=2)
    assert {(r.full_epochs, r.take_tokens) for r in every.collect()} == {(2, 0)}
    assert mix_sources(docs.limit(0), levels, {}).count() == 0
    assert mix_sources(docs.where("text is null"), levels, {}).count() == 0


def taken(rows):
    return sum(r.n_tokens * r.full_epochs + r.take_tokens for r in rows)


def test_budget_is_met_with_repeated_and_null_ids(spark):
    ten, thirty = " ".join("abcdefghij"), " ".join(["w"] * 30)
    repeated = [(1, ten, "s")] * 3 + [(2, thirty, "s")]
    nulls = [(None, ten, "s")] * 5 + [(None, "x y", "t")]
    several = [(7, f"{ten} {k % 3}", "s") for k in range(9)] + [(None, None, "s"), (7, "", "s")]
    source = {"source": F.col("source")}
    every = repeated + nulls + several
    for rows, parts, budgets in ((repeated, 1, (31, 45)), (nulls, 1, (8, 59)), (every, 4, (101, 230, 300))):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        for budget in budgets:
            got = mix_sources(docs, source, {}, budget=budget, max_epochs=2).collect()
            assert taken(got) == budget, (budget, got)
            assert all(0 <= r.take_tokens <= r.n_tokens for r in got) and len(got) <= len(rows)
    assert [r.take_tokens for r in mix_sources(
        spark.createDataFrame(nulls[:5], "doc_id long, text string, source string"), source, {}, budget=8, max_epochs=1).collect()] == [8]


def test_columns_named_like_inner_ones_keep_their_values(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5, "x", 9, 3, 4)], "doc_id long, text string, source string, _leaf int, _h string,"
                                 " _cut int, _mix int, _MIX_k int")
    (r,) = mix_sources(docs, {"source": F.col("source"), "own": F.col("_h")}, {}, budget=1, max_epochs=1).collect()
    assert tuple(r) == (1, "a b", "s", 5, "x", 9, 3, 4, 2, 0, 1)


def test_long_texts_count_whole(spark):
    docs = spark.createDataFrame([(1, "w " * 300_000, "s"), (2, "w", "s")], "doc_id long, text string, source string")
    got = mix_sources(docs, {"source": F.col("source")}, {}, budget=299_999, max_epochs=1).collect()
    assert taken(got) == 299_999
