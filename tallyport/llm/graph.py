"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.runtime import settle_table

#: Rounds whose mappings are joined in one plan.
CHAIN = 4


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (``a``, ``b``).

    Each round maps every node to its smallest neighbour (or to itself), joins the nodes so
    mapped, and goes on with the edges that remain between different nodes.  The first
    round goes by the nodes' own order, which settles stars around their smallest node; later ones
    draw an order anew, so that the number of edges falls by a factor each round.  A node
    with very many edges is only ever a grouping key of a combined minimum or one side of
    a join that can be split.
    """
    found, steps, turn = None, [], 0
    rest = settle_table(edges.select("a", "b").where("a != b").distinct(), "edges")
    while rest.limit(1).count():
        both = rest.union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def order(name: str, turn: int = turn):
            return F.xxhash64(F.lit(turn), name) if turn else F.lit(0).cast("bigint")

        nearest = both.groupBy("a").agg(F.min(F.struct(order("b").alias("h"), "b")).alias("m"))
        own = F.struct(order("a").alias("h"), F.col("a").alias("b"))
        step = settle_table(nearest.select(F.col("a").alias("node"), F.least(own, "m")["b"].alias("root")), "step")
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        joined = rest.join(left, "a").join(right, "b").where("ra != rb")
        pairs = joined.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        rest = settle_table(pairs.distinct(), "edges")
        if len(steps) == CHAIN:
            found, steps = settle_table(_followed(found, steps), "roots"), []
        turn += 1
    if turn == 0:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return settle_table(_followed(found, steps), "roots") if steps else found


def _followed(found: DataFrame | None, steps: list[DataFrame]) -> DataFrame:
    """The mapping of ``found`` and then of each step."""
    for step in steps:
        if found is None:
            found = step
            continue
        onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
