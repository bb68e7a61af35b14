"""Filter interaction audit: potentials of removal games over all coalitions of filters.

The game of a part gives each coalition of filters the number of documents
that fail at least one of its filters. Hart and Mas-Colell's potential P is 0
for no filter and, for a coalition S, the mean of what S removes plus the sum
of the potentials of S less one filter, over |S|. A filter's Shapley value is
the potential of all filters less the potential without that filter.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import staged

#: All orders of the filters are listed, so there are few of them.
MOST_FILTERS = 7


def removal_games(docs: DataFrame, part: Column, fails: Mapping[str, Column], marks: Mapping[str, Column],
                  weight: Column | None = None) -> DataFrame:
    """(part, games): per part an array over the 2^m coalitions of the m
    filters, entry S (bit k: the k-th filter) a struct of `removed` and of one
    count for each mark: documents, and marked ones, failing a filter of S.
    `docs`, and a long for each mark, count the whole part.

    The documents are counted once by what they fail (at most 2^m groups a
    part, combined map-side); coalitions are sums of those counts.
    """
    count = F.lit(1).cast("long") if weight is None else weight
    mask = F.lit(0)
    for k, (_, failed) in enumerate(fails.items()):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    seen = docs.select(part.alias("part"), mask.alias("mask"), count.alias("removed"),
                       *[F.when(m, count).otherwise(F.lit(0)).alias(name) for name, m in marks.items()])
    counts = ["removed", *marks]
    seen = seen.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])
    every = seen.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << len(fails)) - 1))))
    inside = F.col("coalition").bitwiseAND(F.col("mask")) != 0
    games = every.groupBy("part", "coalition").agg(
        F.sum("removed").alias("docs"), *[F.sum(F.when(inside, F.col(c)).otherwise(0)).alias(c) for c in counts]
    )
    games = games.groupBy("part").agg(
        F.max("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("coalition", *counts))).alias("games")
    )
    return games


def potentials(games: Column, n_filters: int) -> list[Column]:
    """Columns to be added one after the other as `potential`: n_filters!
    times the potential of every coalition, exact in integers. The k-th fills
    in the coalitions of k filters from those of k - 1."""
    scale, size = math.factorial(n_filters), 1 << n_filters

    def filled(k: int) -> Column:
        known = F.col("potential")

        def entry(s: Column) -> Column:
            smaller = F.lit(0).cast("long")
            for bit in (1 << i for i in range(n_filters)):
                less_one = F.get(known, s.bitwiseXOR(F.lit(bit)))
                smaller = smaller + F.when(s.bitwiseAND(F.lit(bit)) != 0, less_one).otherwise(0)
            # a division without rest: n_filters! holds every divisor on the way
            whole = F.call_function("div", scale * F.get(games, s)["removed"] + smaller, F.lit(k))
            return F.when(F.bit_count(s) == k, whole).otherwise(F.get(known, s))

        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), entry)

    return [F.transform(games, lambda g: F.lit(0).cast("long")), *[filled(k) for k in range(1, n_filters + 1)]]


def audit_filters(docs: DataFrame, part: Column, fails: Mapping[str, Column], marks: Mapping[str, Column],
                  weight: Column | None = None) -> DataFrame:
    """How filters share the documents they remove, in every order of them.

    `fails` names each filter by one character and gives the condition on
    which a row of `docs` fails it (null: passes); `marks` are conditions
    whose documents are counted too (null: not marked); a row counts for
    `weight` documents (1).

    One row per part, filter_order (all m! orders, applied left to right) and
    step (1 to m): kept, removed, redundant (failing this step's filter but
    removed earlier), unique_fails (failing no other filter), a count of the
    removed for each mark, and shapley: the documents that the filter removes,
    summed over all m! orders. Differences of coalitions give the steps; the
    potential gives shapley.

    Parts that are null and rows that repeat count like any other. A part
    without a failing document has its rows too, zeros in them. An empty table
    has no part and gives no row. Columns of `docs` named like a result do not
    clash: only the given expressions are read.
    """
    names = "".join(fails)
    if not names or len(names) != len(fails) or len(fails) > MOST_FILTERS:
        raise ValueError(f"filters are named by one character each, at most {MOST_FILTERS} of them")
    m = len(fails)
    rows = removal_games(docs, part, fails, marks, weight)
    for potential in potentials(F.col("games"), m):
        rows = rows.withColumn("potential", potential)

    rows = rows.withColumn("filter_order", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(names)])))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(m))))
    bits = F.transform(F.split("filter_order", ""), lambda c: F.pow(2.0, F.instr(F.lit(names), c) - 1).cast("int"))
    rows = rows.withColumn("bits", bits)
    rows = rows.withColumn("bit", F.get("bits", F.col("step") - 1))
    after = F.aggregate(F.slice("bits", F.lit(1), F.col("step")), F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("after", after).withColumn("before", F.col("after") - F.col("bit"))
    whole = (1 << m) - 1

    def at(coalition: Column, count: str = "removed") -> Column:
        return F.get("games", coalition)[count]

    others = F.lit(whole) - F.col("bit")
    removed = at(F.col("after")) - at(F.col("before"))
    return rows.select(
        "part", "filter_order", "step",
        (F.col("docs") - at(F.col("after"))).alias("kept"), removed.alias("removed"),
        (at(F.col("bit")) - removed).alias("redundant"), (at(F.lit(whole)) - at(others)).alias("unique_fails"),
        *[(at(F.col("after"), c) - at(F.col("before"), c)).alias(c) for c in marks],
        (F.get("potential", F.lit(whole)) - F.get("potential", others)).alias("shapley"),
    )


def quality_counts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """Documents counted by (part, A, B, C, D, E, good, toxic), as `n`.

    A: under 50 words (runs without ASCII white space). B: 100 times the
    distinct words under 65 times the words. C: 100 times the letters A-Z over
    5 times the code points. D: holds any of #$%&*|. E: a document with a
    smaller id has the same text. good, toxic: a row of `labels` with that id
    has quality 1, toxic 1.

    A null text is empty, a null part the empty string. A null id is neither
    smaller nor larger than another, so its row passes E, and it has no
    labels. Rows that share id and text pass or fail E together. Whole texts
    are read once; from then on a row is its id, a digest and flags. Texts are
    told apart by SHA-256. What meets by digest are counts by id, combined
    map-side, so a text that a third of all rows share gathers nowhere.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    rows = rows.select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), (n < 50).alias("A"),
        (distinct.cast("long") * 100 < n.cast("long") * 65).alias("B"),
        (capitals * 100 > F.length("text").cast("long") * 5).alias("C"), F.col("text").rlike("[#$%&*|]").alias("D"),
    )
    marked = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = rows.join(marked, "id", "left")
    own = ["part", "A", "B", "C", "D"]
    marks = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    by_id = rows.groupBy("digest", *own, *marks, "id").agg(F.count(F.lit(1)).alias("n"))
    cells = by_id.groupBy("digest", *own, "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("id").alias("least"), F.min_by("n", "id").alias("at_least"),
    )
    # both readers below want it, and would read and split every text again
    cells = staged(cells, "audit-cells")
    first = cells.groupBy("digest").agg(F.min("least").alias("first"))
    cells = cells.join(first, "digest")
    ahead = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    repeats = F.col("n") - F.col("no_id") - ahead
    split = F.array(F.struct(F.lit(False).alias("E"), (F.col("n") - repeats).alias("n")), F.struct(F.lit(True).alias("E"), repeats.alias("n")))
    cells = cells.select(*own, "good", "toxic", F.inline(split)).where("n > 0")
    return cells.groupBy(*own, "E", "good", "toxic").agg(F.sum("n").alias("n"))
