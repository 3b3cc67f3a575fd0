"""Sources mixed to target weights by hierarchical budgets.

A token budget flows down a tree (domain, language, source by default). Each
node shares its budget among its children by weight. A child that cannot use
its share, because its documents repeated ``max_epochs`` times are fewer,
takes what it can, and its siblings take the rest by weight; only what a whole
subtree cannot use reaches the subtree's own siblings. All shares are exact
integers. A leaf's tokens are then the shortest prefix of seeded epochs that
reaches its budget: in every epoch its documents stand in another hashed order.

Whole epochs need no order at all. Within the last epoch hash buckets are
summed up first; buckets that fit are taken whole, and only the one bucket of
each leaf in which the budget ends is sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.operators.ranking import ranked_in_groups
from clickweave.session import materialize

SPACE = r"[ \t\n\x0B\f\r]+"


def word_count(text: Column) -> Column:
    """Number of words cut at ASCII white space (null: 0)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def _share(nodes: DataFrame, parents: list[str], key: str) -> DataFrame:
    """``nodes`` (parents, key, weight, room, budget of the parent) with the
    node's own budget in place of the parent's.

    Sorted by room per weight, nodes that are filled come first: a node is
    filled if its room is not above its part of what those before it leave.
    """
    group = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    order = group.orderBy(F.col("room") / F.col("weight"), F.col(key).asc_nulls_first())
    upto, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    big = "decimal(38,0)"
    filled = nodes.withColumn("spent", F.coalesce(F.sum("room").over(upto), F.lit(0))).withColumn(
        "weights", F.sum("weight").over(onward)
    )
    filled = filled.withColumn(
        "full", F.col("room").cast(big) * F.col("weights") <= (F.col("budget") - F.col("spent")).cast(big) * F.col("weight")
    )
    rest = filled.withColumn("left", F.col("budget") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(group))
    open_weight = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    rest = rest.withColumn("open", F.sum(open_weight).over(group)).withColumn(
        "reached", F.sum(open_weight).over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    part = "cast(reached as decimal(38,0)) * left div open - cast(reached - weight as decimal(38,0)) * left div open"
    return rest.withColumn("own", F.when(F.col("full"), F.col("room")).otherwise(F.expr(part))).select(
        *parents, key, F.col("own").cast("long").alias("budget")
    )


def leaf_budgets(
    leaves: DataFrame,
    levels: list[str],
    weights: dict[tuple, int] | None = None,
    total_tokens: int | None = None,
    max_epochs: int = 4,
) -> DataFrame:
    """Budgets of ``leaves`` (the level columns and ``tokens``): level columns,
    tokens, budget.

    ``weights``: whole numbers by path prefix, such as ``("web",)`` or
    ``("web", "en")``; 1 where none is given, and 0 takes nothing.
    ``total_tokens``: all tokens of the leaves if None; never more than the
    leaves hold in ``max_epochs``. Nulls are nodes like other values.
    """
    spark = leaves.sparkSession
    leaves = materialize(leaves.withColumn("room", F.col("tokens") * max_epochs), "leaves")
    by_path = weights or {}

    def weighted(depth: int) -> DataFrame:
        keys = levels[:depth]
        level = ", ".join(f"`{k}` string" for k in keys)
        rows = [(*p, int(w)) for p, w in by_path.items() if len(p) == depth]
        given = spark.createDataFrame(rows, f"{level}, weight long")
        nodes = leaves.groupBy(*keys).agg(F.sum("room").alias("room"))
        out = nodes.join(given, _same(nodes, given, keys), "left").select(*(nodes[k] for k in keys), "room", "weight")
        out = out.withColumn("weight", F.coalesce("weight", F.lit(1)))
        return out.withColumn("room", F.when(F.col("weight") > 0, F.col("room")).otherwise(0)).withColumn(
            "weight", F.greatest("weight", F.lit(1))
        )

    # A node's room is what its weighted descendants can use.
    rooms = {len(levels): materialize(weighted(len(levels)), "rooms")}
    for depth in range(len(levels) - 1, 0, -1):
        keys, below = levels[:depth], rooms[depth + 1]
        usable = below.groupBy(*keys).agg(F.sum("room").alias("usable"))
        own = weighted(depth)
        joined = own.join(usable, _same(own, usable, keys)).select(*(own[k] for k in keys), F.least("room", "usable").alias("room"), "weight")
        rooms[depth] = materialize(joined, "rooms")
    held = rooms[1].agg(F.coalesce(F.sum("room"), F.lit(0)).alias("n")).collect()[0]["n"]
    wanted = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).collect()[0]["n"] if total_tokens is None else total_tokens
    budgets = None
    for depth in range(1, len(levels) + 1):
        nodes, parents = rooms[depth], levels[: depth - 1]
        if budgets is None:
            nodes = nodes.withColumn("budget", F.lit(min(held, wanted)).cast("long"))
        else:
            nodes = nodes.join(budgets, _same(nodes, budgets, parents)).select(*(nodes[k] for k in levels[:depth]), "room", "weight", "budget")
        budgets = _share(nodes, parents, levels[depth - 1])
    return leaves.join(budgets, _same(leaves, budgets, levels)).select(*(leaves[k] for k in levels), "tokens", "budget")


def mix_sources(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple, int] | None = None,
    total_tokens: int | None = None,
    max_epochs: int = 4,
    seed: int = 0,
    tokens: Column | None = None,
    buckets: int = 4096,
) -> DataFrame:
    """``docs`` mixed to ``weights``: a row for each time a document is taken,
    with ``epoch``, ``n_tokens`` and ``leaf_budget``.

    ``levels``: the tree from its top, as named string columns; ``tokens``:
    a document's size (words by default). An epoch that fits its leaf's budget
    is taken whole; of the next one, ordered by MD5 of ``seed:epoch:doc_id``,
    the documents that start before the budget is reached. So a leaf gets its
    budget and less than one document more, and texts are never cut. Leaves
    without tokens get no budget and none of their documents is taken.

    Null levels are a branch of their own; null texts have no tokens; rows
    that repeat a doc_id follow each other in the order of their texts.
    Columns named like those added are replaced; all others keep their names
    and values, whatever they are called. An empty table gives an
    empty table.
    """
    keys = list(levels)
    added = {"epoch", "n_tokens", "leaf_budget"}
    columns = [c for c in docs.columns if c.lower() not in added]
    # the columns of docs go under numbers until the end, so none meets a name that is used in between
    hidden = {c: f"column_{i}" for i, c in enumerate(columns)}
    doc_id, text = (next(h for c, h in hidden.items() if c.lower() == name) for name in ("doc_id", "text"))
    size = word_count(F.col("text")) if tokens is None else tokens
    path = [f"level_{i}" for i in range(len(keys))]
    base = docs.select(
        *(F.col(f"`{c}`").alias(h) for c, h in hidden.items()),
        size.alias("n_tokens"),
        *(levels[k].cast("string").alias(p) for k, p in zip(keys, path)),
    )

    leaves = base.groupBy(*path).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, path, weights, total_tokens, max_epochs).filter("budget > 0")
    plan = materialize(
        plan.withColumn("whole", F.expr("budget div tokens")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")),
        "leaf_plan",
    )
    def placed(rows: DataFrame, leaf: DataFrame) -> DataFrame:
        epoch_key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
        at = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)
        joined = rows.join(leaf, _same(rows, leaf, path)).drop(*(leaf[k] for k in path))
        return joined.withColumn("order_key", epoch_key).withColumn("bucket", F.floor(at))

    # One row a leaf: the bucket in which its budget ends, and what the buckets before it hold.
    sums = placed(base, plan).filter("rest > 0").groupBy(*path, "bucket", "rest").agg(F.sum("n_tokens").alias("held"))
    ahead = W.partitionBy(*path).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    ends = ends.filter("before < rest and before + held >= rest").select(*path, F.col("bucket").alias("edge"), "before")
    plan = materialize(
        plan.join(ends, _same(plan, ends, path), "left").select(*(plan[c] for c in plan.columns), "edge", "before"), "leaf_edges"
    )

    shown = [F.col(h).alias(c) for c, h in hidden.items()]
    out = [*shown, "epoch", "n_tokens", F.col("budget").alias("leaf_budget")]
    planned = placed(base, plan)
    times = F.col("whole") + F.when(F.col("bucket") < F.col("edge"), 1).otherwise(0)
    taken = planned.withColumn("times", times).filter("times > 0")
    whole = taken.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    last = planned.filter(F.col("bucket") == F.col("edge"))
    # rows without a doc_id share an order key, so the last bucket may be large: ranks come from ranges of it
    order = [F.col("order_key"), F.col(doc_id), F.col(text)]
    summed = ranked_in_groups(last, path, order, running={"upto": F.col("n_tokens")}, rank="place")
    start = F.col("before") + F.col("upto") - F.col("n_tokens")
    edge = summed.filter(start < F.col("rest")).withColumn("epoch", F.col("whole"))
    return whole.select(*out).unionByName(edge.select(*out))
