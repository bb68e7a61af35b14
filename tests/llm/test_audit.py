"""Filter audit against every order played out document by document."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from logsieve.llm.audit import audit_filters, quality_counts

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def played(docs, names="ABCDE"):
    """docs: (part, failed letters, good, toxic). {(part, order, step): counts}"""
    out, shapley = {}, Counter()
    by_part = defaultdict(list)
    for part, *rest in docs:
        by_part[part].append(rest)
    for part, rows in by_part.items():
        for order in map("".join, permutations(names)):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in rows)
                out[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(set(r[0]) == {f} for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
                shapley[part, f] += len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def filters():
    return {c: F.col(c) for c in "ABCDE"}


def marks():
    return {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}


def counted(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in df.collect()}


@pytest.mark.parametrize("names", ["A", "AB", "ABC", "ABCDE"])
def test_every_order_played_out(spark, names):
    rng = random.Random(len(names))
    docs = [(rng.choice(["x", "y", None]), "".join(f for f in names if rng.random() < 0.35), rng.random() < 0.3, rng.random() < 0.2)
            for _ in range(150)]
    table = spark.createDataFrame(docs, "p string, failed string, good boolean, toxic boolean")
    fails = {f: F.col("failed").contains(f) for f in names}
    assert counted(audit_filters(table, F.col("p"), fails, marks())) == played(docs, names)


def test_nulls_weights_clashing_columns_and_no_failing_row(spark):
    rows = [("x", True, None, 3, None), ("x", None, None, 2, True), ("y", None, False, 4, True)]
    table = spark.createDataFrame(rows, "part string, step boolean, mask boolean, removed long, good boolean")
    got = audit_filters(table, F.col("part"), {"s": F.col("step"), "m": F.col("mask")}, {"lost": F.col("good")}, F.col("removed"))
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.lost, r.shapley) for r in got.collect()}
    assert found == {
        ("x", "sm", 1): (2, 3, 0, 3, 0, 6), ("x", "sm", 2): (2, 0, 0, 0, 0, 0),
        ("x", "ms", 1): (5, 0, 0, 0, 0, 0), ("x", "ms", 2): (2, 3, 0, 3, 0, 6),
        ("y", "sm", 1): (4, 0, 0, 0, 0, 0), ("y", "sm", 2): (4, 0, 0, 0, 0, 0),
        ("y", "ms", 1): (4, 0, 0, 0, 0, 0), ("y", "ms", 2): (4, 0, 0, 0, 0, 0),
    }


def test_too_many_or_long_names(spark):
    table = spark.range(1)
    for names in (["ab"], list("abcdefgh"), []):
        with pytest.raises(ValueError):
            audit_filters(table, F.lit("p"), {n: F.lit(True) for n in names}, {})


def judged(docs, labels):
    """(part, failed, good, toxic) of (doc_id, text, source) by the five conditions, in plain Python."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i}, {i for i, _, t in labels if t == 1 and i}
    out = []
    for i, text, source in docs:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        failed = "A" if len(words) < 50 else ""
        failed += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        failed += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
        failed += "D" if set(text) & set("#$%&*|") else ""
        failed += "E" if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs) else ""
        out.append((source or "", failed, i in good, i in toxic))
    return out


def _cases():
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "delta", "éa", "#x", "五", "a b"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 49, 50, 51, 80]))), rng.choice(["s1", "s2", None, ""]))
            for i in range(60)]
    docs += [(100 + i, docs[i % 7][1], "s1") for i in range(20)]  # copies
    docs += [(5, docs[5][1], "s1"), (5, "other text of a repeated id", "s2"), (200, None, "s2"), (201, "", None), (202, " \t\n", "s1")]
    docs += [(None, "alpha", "s1"), (None, "alpha", "s1"), (300, "alpha", "s2"), (301, "alpha", "s1")]
    docs += [(400, "w" * 100_000 + " x" * 200_000, "s1"), (401, "\x0b".join(f"w{k}" for k in range(50)), "s2")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in list(range(2, 60, 2)) + [5, 5, 200, 999]] + [(None, 1, 1)]
    return docs, labels


def test_five_filters_on_nulls_copies_and_long_texts(spark):
    docs, labels = _cases()
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    table = table.withColumns({"id": F.lit(1), "words": F.lit("x"), "A": F.lit(None), "n": F.lit(2)})
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("?"))
    counts = quality_counts(table, marked)
    want = Counter((p, *[f in failed for f in "ABCDE"], g, t) for p, failed, g, t in judged(docs, labels))
    assert {tuple(r)[:-1]: r.n for r in counts.select("part", *"ABCDE", "good", "toxic", "n").collect()} == dict(want)
    assert counted(audit_filters(counts, F.col("part"), filters(), marks(), F.col("n"))) == played(judged(docs, labels))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(quality_counts(docs, labels), F.col("part"), filters(), marks(), F.col("n")).count() == 0
    one = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    assert audit_filters(quality_counts(one, labels), F.col("part"), filters(), marks(), F.col("n")).count() == 600


def test_shapley_shares_out_what_is_removed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = audit_filters(quality_counts(docs, labels), F.col("part"), filters(), marks(), F.col("n"))
    rows = got.groupBy("part", "filter_order").agg(F.sum("shapley").alias("s"), F.sum("removed").alias("r"), F.min("kept").alias("k"))
    rows = rows.collect()
    assert rows and all(r.s == 120 * r.r for r in rows)
    assert sum(r.r + r.k for r in rows) == 120 * docs.count()
