"""Mixing sources to target weights: hierarchical token budgets and seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsieve.llm.common import staged, without

#: Documents of a leaf that are ranked together, about.
BUCKET_DOCS = 2048

ADDED = ["n_tokens", "full_epochs", "take_tokens"]


def word_count(text: Column) -> Column:
    """Runs without ASCII white space; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(0)).cast("long")


def _path(columns: Sequence[Column | str]) -> Column:
    """The names from the root as a JSON list; null is a name of its own."""
    return F.to_json(F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]),
                     {"ignoreNullFields": "false"})


def _weight(levels: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    """The weight of a node: by its whole path, else by ("*", name), else 1."""
    depth = len(levels)
    out = F.lit(1)
    wild = [F.when(F.col(levels[-1]) == k[-1], w) for k, w in weights.items() if k[:-1] == ("*",) and depth > 1]
    if wild:
        out = F.coalesce(*wild, out)
    exact = [F.when(_all_equal(levels, k), w) for k, w in weights.items() if len(k) == depth and k[0] != "*"]
    return (F.coalesce(*exact, out) if exact else out).cast("decimal(38,0)")


def _all_equal(levels: Sequence[str], names: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for level, name in zip(levels, names):
        out = out & (F.col(level) == name)
    return out


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], budget: int, max_epochs: int
) -> DataFrame:
    """(levels, tokens, docs, budget) per leaf of `leaves` (levels, tokens, docs).

    Weights go down the tree: a node's budget is shared among its children by
    weight. A child that holds less than its share (its tokens times
    `max_epochs`) takes what it holds, and the rest goes to its siblings by
    weight; only what a whole family cannot hold goes up to the siblings of
    its parent. Whole tokens, all in integers; a family's budgets add up to
    its parent's. A weight of 0 gives a subtree nothing.
    """
    node = leaves.withColumn("cap", F.when(_weight(levels, weights) > 0, F.col("tokens") * max_epochs).otherwise(0))
    tree = [node.withColumn("cap", F.col("cap").cast("decimal(38,0)"))]
    for depth in range(len(levels) - 1, 0, -1):
        own = list(levels[:depth])
        up = tree[0].groupBy(*own).agg(F.sum("cap").cast("decimal(38,0)").alias("cap"))
        tree.insert(0, up.withColumn("cap", F.when(_weight(own, weights) > 0, F.col("cap")).otherwise(0)))
    held = int(tree[0].agg(F.sum("cap")).first()[0] or 0)
    spread = None
    for depth, nodes in enumerate(tree, 1):
        own = list(levels[:depth])
        nodes = nodes.withColumn("w", _weight(own, weights)).withColumn("path", _path(own))
        if spread is None:
            nodes = nodes.withColumns({"up": F.lit("[]"), "b": F.lit(min(held, budget)).cast("decimal(38,0)")})
        else:
            nodes = nodes.withColumn("up", _path(own[:-1])).join(spread, "up")
        by_name = F.col(own[-1]).asc_nulls_last()
        by_need = Window.partitionBy("up").orderBy(
            (F.col("w") == 0), (F.col("cap").cast("double") / F.when(F.col("w") > 0, F.col("w")).cast("double")), by_name
        )
        before = F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        after = F.sum("w").over(by_need.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("before", before.cast("decimal(38,0)")).withColumn("after", after.cast("decimal(38,0)"))
        nodes = nodes.withColumn("full", F.expr("w > 0 and cap * after <= w * (b - before)"))
        family = Window.partitionBy("up")
        nodes = nodes.withColumns({
            "left": F.expr("b") - F.sum(F.expr("if(full, cap, 0)")).over(family),
            "share": F.sum(F.expr("if(full, 0, w)")).over(family),
            "upto": F.sum(F.expr("if(full, 0, w)")).over(family.orderBy(by_name).rowsBetween(Window.unboundedPreceding, 0)),
        })
        nodes = nodes.withColumns({c: F.col(c).cast("decimal(38,0)") for c in ("left", "share", "upto")})
        given = F.expr(
            "if(full, cast(cap as bigint), if(share = 0, 0, (left * upto) div share - (left * (upto - w)) div share))"
        )
        nodes = nodes.withColumn("budget", given)
        spread = nodes.select(F.col("path").alias("up"), F.col("budget").cast("decimal(38,0)").alias("b"))
    return nodes.select(*levels, "tokens", "docs", "budget")


def _rank(id_col: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit(""))))


def mix_sources(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple[str, ...], int], *,
    budget: int | None = None, budget_share: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None,
) -> DataFrame:
    """`docs` less what the mixture leaves out, with n_tokens, full_epochs and
    take_tokens added.

    `levels` names the tree from the root, each a column expression; `weights`
    gives a node's weight by its path of names, or by ("*", name) wherever it
    occurs; 1 otherwise. The budget is `budget` tokens, or `budget_share` of
    all tokens, shared out by `leaf_budgets`. A leaf's budget is filled with
    epochs over all its documents, each in an order of its own seeded by
    (seed, epoch): full_epochs times the whole leaf, and then the prefix of
    one more epoch that reaches the budget. take_tokens is what the prefix
    takes of a document, less than the document only at the cut.

    Null names are nodes of their own. Null or empty texts have no tokens and
    fill nothing. Rows of one id (null is one too) in a leaf follow each other
    in the order of a hash of their texts; of equal texts at the cut as many
    are taken as the budget holds, so that it is met to the token whatever the
    ids are. Texts of any length count whole. An empty table gives no row.
    Input columns named like an added one are replaced; all others keep their
    names and values.

    One narrow table (leaf, tokens, id) is staged. A leaf's cut is found from
    token sums of hash buckets, and only the bucket of the cut is ranked, so
    a leaf that holds a third of all rows is never sorted in one task. The
    documents are then filtered where they are, by their leaf's cut. Only rows
    that share the place of a cut are numbered, within the part of the table
    that each comes from.
    """
    count = tokens if tokens is not None else word_count(F.col(text_col))
    names = [f"_level{k}" for k in range(len(levels))]
    named = {n: e.cast("string") for n, e in zip(names, levels.values())}
    narrow = docs.select(F.col(id_col).cast("string").alias("id"), count.alias("tokens"), F.xxhash64(text_col).alias("x"),
                         *[e.alias(n) for n, e in named.items()])
    narrow = staged(narrow.withColumn("leaf", _path(names)), "mix-docs")
    leaves = staged(
        narrow.groupBy("leaf", *names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "mix-leaves"
    )
    if budget is None:
        budget = int(leaves.agg(F.sum("tokens")).first()[0] or 0) * budget_share[0] // budget_share[1]
    plan = leaf_budgets(leaves, names, weights, budget, max_epochs).withColumn("leaf", _path(names))
    plan = plan.where("budget > 0").select(
        "leaf", "docs", F.expr("budget div tokens").alias("full_epochs"), F.expr("budget % tokens").alias("rest")
    )
    plan = staged(plan, "mix-plan")

    keyed = narrow.join(plan.where("rest > 0"), "leaf").withColumn("h", _rank(F.col("id"), F.col("full_epochs"), seed))
    buckets = F.greatest(F.lit(1), F.expr(f"docs div {BUCKET_DOCS}"))
    keyed = keyed.withColumn("bucket", F.expr("cast(conv(substring(h, 1, 8), 16, 10) as bigint)") * buckets)
    keyed = keyed.withColumn("bucket", F.shiftright("bucket", 32))
    sums = keyed.groupBy("leaf", "bucket", "rest").agg(F.sum("tokens").alias("held"))
    ahead = Window.partitionBy("leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    cut_at = sums.where("ahead < rest and rest <= ahead + held").select("leaf", "bucket", "ahead")
    inside = keyed.join(cut_at, ["leaf", "bucket"]).groupBy("leaf", "h", "x", "tokens", "rest", "ahead").agg(
        F.count(F.lit(1)).alias("n")
    )
    own = F.col("tokens") * F.col("n")
    running = F.sum(own).over(Window.partitionBy("leaf").orderBy("h", "x", "tokens")) + F.col("ahead")
    inside = inside.withColumn("upto", running).where("upto >= rest")
    place = F.struct("h", "x", "tokens")
    cuts = inside.groupBy("leaf").agg(F.min_by(F.struct(
        place.alias("cut"), (F.col("rest") - F.col("upto") + own).alias("take"), "n"
    ), place).alias("c"))
    plan = staged(plan.join(cuts.select("leaf", "c.*"), "leaf", "left").select(
        "leaf", "full_epochs", F.struct("leaf", "cut", "take", "n").alias("plan")
    ), "mix-cuts")

    mark = "_mix"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark = "_" + mark
    rows = without(docs, ADDED).withColumns({"n_tokens": count, mark: _path(list(named.values()))})
    rows = rows.join(plan.select(F.col("leaf").alias(f"{mark}_leaf"), "full_epochs", F.col("plan").alias(f"{mark}_plan")),
                     F.col(mark) == F.col(f"{mark}_leaf"))
    cut = F.col(f"{mark}_plan")["cut"]
    rows = rows.withColumn(f"{mark}_h", _rank(F.col(id_col), F.col("full_epochs"), seed))
    # the text is hashed only where the id's place is that of the cut
    here = F.when(F.col(f"{mark}_h") != cut["h"], F.when(F.col(f"{mark}_h") < cut["h"], -1).otherwise(1))
    text_place, cut_place = F.xxhash64(text_col), cut["x"]
    if tokens is not None:  # else equal texts have equal counts
        text_place, cut_place = (
            F.struct(x.alias("x"), n.alias("n")) for x, n in ((text_place, F.col("n_tokens")), (cut_place, cut["tokens"]))
        )
    here = F.coalesce(here, F.when(text_place < cut_place, -1).when(text_place > cut_place, 1).otherwise(0))
    rows = rows.withColumn(f"{mark}_side", F.when(cut.isNotNull(), here).otherwise(1))
    take = F.col(f"{mark}_plan")["take"]
    most = F.least(F.col("n_tokens"), take)
    shared = plan.where("plan.n > 1").select("leaf").limit(1).count() > 0
    if shared:
        most = F.greatest(F.lit(0), F.least(F.col("n_tokens"), take - F.col(f"{mark}_k") * F.col("n_tokens")))
        rows = _numbered(rows, mark)
    taken = F.when(F.col(f"{mark}_side") < 0, F.col("n_tokens")).when(F.col(f"{mark}_side") == 0, most).otherwise(0)
    rows = rows.withColumn("take_tokens", taken.cast("long"))
    # without n_tokens, so that the filter counts no words
    here = F.col(f"{mark}_k") * cut["tokens"] < take if shared else F.lit(True)
    before = (F.col(f"{mark}_side") < 0) | ((F.col(f"{mark}_side") == 0) & here)
    return rows.where((F.col("full_epochs") > 0) | before).select(*[f"`{c}`" for c in rows.columns if not c.startswith(mark)])


def _numbered(rows: DataFrame, mark: str) -> DataFrame:
    """`rows` with {mark}_k: how many rows before it share its place at the
    cut of its leaf, in the order of the table's parts."""
    tied = staged(rows.where(F.col(f"{mark}_side") == 0).withColumn(f"{mark}_m", F.monotonically_increasing_id()), "mix-tied")
    tied = tied.withColumn(f"{mark}_part", F.shiftright(f"{mark}_m", 33))
    parts = tied.groupBy(F.col(mark).alias(f"{mark}_of"), F.col(f"{mark}_part").alias(f"{mark}_from")).agg(F.count(F.lit(1)).alias(f"{mark}_n"))
    ahead = Window.partitionBy(f"{mark}_of").orderBy(f"{mark}_from").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(f"{mark}_ahead", F.coalesce(F.sum(f"{mark}_n").over(ahead), F.lit(0)))
    tied = tied.join(parts, (F.col(mark) == F.col(f"{mark}_of")) & (F.col(f"{mark}_part") == F.col(f"{mark}_from")))
    inside = F.row_number().over(Window.partitionBy(mark, f"{mark}_part").orderBy(f"{mark}_m")) - 1
    tied = tied.withColumn(f"{mark}_k", inside + F.col(f"{mark}_ahead"))
    others = rows.where(F.col(f"{mark}_side") != 0).withColumn(f"{mark}_k", F.lit(0).cast("long"))
    return others.unionByName(tied.select(*others.columns))
