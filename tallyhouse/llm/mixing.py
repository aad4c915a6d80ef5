"""Mixing sources to target weights: token budgets down a tree, then a seeded prefix of each leaf.

The tree has a level for each of ``levels`` (domain, language, source). Capacities (tokens times
epochs) are added up from the leaves. Then each node's budget is shared among its children by weight; what
a child cannot take goes to its siblings, by weight, and only what all of them together cannot take had already
been left with the node's own siblings, as a node never gets more than its capacity. Shares are
whole tokens, rounded down.

A leaf takes whole epochs while they fit, then the longest prefix, within the rest, of the next epoch's order:
documents by a digest of seed, epoch and id. The prefix is found by sums per digest bucket, so a leaf with
a third of all rows is neither sorted nor windowed as a whole: only its boundary bucket is, a 65,536th of it.

A child that its level's weights don't list has the weight ``unlisted``, by default the smallest positive one listed. One listed
with 0 gets nothing, and its tokens are no capacity of the nodes above it. ``unlisted=0`` is what op2's SQL says: such children get nothing, yet
count in the capacity above.

Defined results: null levels are a child of their own (``""``); a null or empty text has no tokens
and goes with its neighbours in the order; rows with equal ids have one digest and are taken together; other columns are
kept; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.staging import settled

DIGITS = 4  # hex digits of the digest that make a bucket


def count_words(text: Column) -> Column:
    """Words of a text, runs of anything but ``[\\x20\\x09-\\x0D]``; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def weighted(name: Column, weights: dict[str, int], other: int) -> Column:
    """The weight of a child; ``other`` for those not listed."""
    found = F.lit(other)
    for key, weight in weights.items():
        found = F.when(name == key, weight).otherwise(found)
    return found.cast("long")


def shared(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Children (``cap, weight`` and their parent's ``budget``) with their own ``budget``.

    In the order of capacity per weight, a child is full if its share of what is left, among those not yet
    full, is at least its capacity. The rest share what the full ones leave.
    """
    fill = F.col("cap") / F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(None))
    order = Window.partitionBy(*parent).orderBy(fill.asc_nulls_last(), F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ranked = children.withColumn("left", left).withColumn("among", F.sum("weight").over(after))
    full = (F.col("weight") > 0) & (F.col("cap") * F.col("among") <= F.col("weight") * F.col("left"))
    whole = Window.partitionBy(*parent)
    ranked = ranked.withColumn("full", full)
    ranked = ranked.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole))
    ranked = ranked.withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole))
    own = F.when(F.col("full"), F.col("cap")).when(F.col("open") > 0, F.expr("weight * rest div open")).otherwise(0)
    return ranked.withColumn("budget", own.cast("long")).drop("left", "among", "full", "rest", "open")


def budgets(
    leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], share: tuple[int, int], epochs: int, unlisted: int | None = None,
) -> DataFrame:
    """Leaf rows (``levels, tokens``) with ``budget``: ``share`` of all tokens, as the tree allows.

    One row for each leaf; each step groups or orders the children of one node.
    """
    barred = F.lit(False)
    for level in levels:
        barred |= F.col(level).isin([c for c, w in weights.get(level, {}).items() if w <= 0])
    nodes = leaves.withColumn("cap", F.when(barred, 0).otherwise(F.col("tokens") * epochs).cast("long"))
    tokens = leaves.agg(F.sum("tokens")).first()[0] or 0
    above = None
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        own = nodes.groupBy(*path).agg(F.sum("cap").alias("cap"))
        listed = weights.get(level, {})
        least = min((w for w in listed.values() if w > 0), default=1)
        own = own.withColumn("weight", weighted(F.col(level), listed, unlisted if listed and unlisted is not None else least))
        if above is None:
            own = own.withColumn("budget", F.lit(tokens * share[0] // share[1]).cast("long"))
        else:
            own = own.join(above, levels[:depth])
        most = F.sum("cap").over(Window.partitionBy(*levels[:depth]))
        own = own.withColumn("budget", F.least("budget", most))
        above = shared(own, levels[:depth], level).select(*path, "budget")
    return leaves.join(above, levels)


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], share: tuple[int, int],
    epochs: int, seed: str, key: str = "doc_id", unlisted: int | None = None,
) -> DataFrame:
    """``row`` (the document), its leaf levels and ``epoch``, for each time a document is taken."""
    names = list(levels)
    leaf = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()]
    ident = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    rows = settled(docs.select(ident.alias("id"), count_words(F.col("text")).alias("tokens"), *leaf), "mixing-rows")
    plan = settled(cuts(rows, names, weights, share, epochs, seed, unlisted), "mixing-plan")
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), ident.alias("id"), *leaf)
    placed = held.join(plan, names).withColumn("digest", _digest(seed))
    times = F.col("whole") + F.when(F.col("digest") <= F.col("cut"), 1).otherwise(0)
    placed = placed.withColumn("times", times).where("times > 0")
    return placed.select("row", *names, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"))


def _digest(seed: str) -> Column:
    """A document's place in the order of the epoch that its leaf takes in part."""
    return F.md5(F.concat_ws("|", F.lit(seed), (F.col("whole") + 1).cast("string"), F.col("id")))


def cuts(
    rows: DataFrame, names: list[str], weights: dict[str, dict[str, int]], share: tuple[int, int], epochs: int, seed: str, unlisted: int | None = None,
) -> DataFrame:
    """One row for each leaf: ``whole`` epochs, and the last digest (``cut``) that the next one reaches."""
    leaves = settled(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "mixing-leaves")
    plan = budgets(leaves, names, weights, share, epochs, unlisted)
    plan = plan.withColumn("whole", F.expr(f"cast(if(tokens > 0, least(budget div tokens, {epochs}), 0) as int)"))
    plan = settled(plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")).select(*names, "whole", "rest"), "mixing-shares")
    placed = rows.join(plan.where("rest > 0"), names).withColumn("digest", _digest(seed)).withColumn("bucket", F.substring("digest", 1, DIGITS))
    sums = placed.groupBy(*names, "bucket", "rest").agg(F.sum("tokens").alias("held"))
    ahead = F.sum("held").over(Window.partitionBy(*names).orderBy("bucket")) - F.col("held")
    edge = sums.withColumn("room", F.col("rest") - ahead).where("room >= 0 and room < held")
    edge = settled(edge.select(*names, "bucket", "room"), "mixing-edges")
    near = placed.join(edge, [*names, "bucket"]).groupBy(*names, "bucket", "room", "digest").agg(F.sum("tokens").alias("held"))
    upto = F.sum("held").over(Window.partitionBy(*names, "bucket").orderBy("digest"))
    last = near.withColumn("upto", upto).where("upto <= room").groupBy(*names).agg(F.max("digest").alias("last"))
    found = edge.join(last, names, "left").select(*names, F.coalesce("last", "bucket").alias("cut"))
    return plan.join(found, names, "left").select(*names, "whole", F.coalesce("cut", F.lit("")).alias("cut"))
