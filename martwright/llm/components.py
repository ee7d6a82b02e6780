"""Connected components of a link table by repeated joins (no link leaves Spark's tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored

ROUNDS_MOST = 60


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of ``links`` (a, b).

    Each round, every node's parent's parent takes the smallest grandparent among the node's
    neighbours, and every node its own smallest one; then parents are skipped. Hubs cost no
    more than their links: minima are taken before the shuffle. The rounds needed grow with
    the logarithm of the diameter.
    """
    pairs = links.select("a", "b").where("a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "links")
    nodes = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("id"), F.least("a", "m").alias("f")), "nodes")
    for _ in range(ROUNDS_MOST):
        parent = nodes.select(F.col("id").alias("f"), F.col("f").alias("g"))
        state = stored(nodes.join(parent, "f").select("id", "f", "g"), "nodes")
        near = (both.join(state.select(F.col("id").alias("b"), F.col("g").alias("m")), "b")
                .groupBy("a").agg(F.min("m").alias("m")))
        offers = state.join(near, state["id"] == near["a"]).select("id", "f", "g", "m")
        hooks = offers.select(F.explode(F.array(
            F.struct(F.col("f").alias("id"), F.least("m", "g").alias("f")),
            F.struct("id", F.least("m", "g").alias("f")))).alias("x")).select("x.id", "x.f")
        after = stored(hooks.groupBy("id").agg(F.min("f").alias("f")), "nodes")
        moved = after.join(nodes.select("id", F.col("f").alias("was")), "id").where("f <> was")
        unsettled = state.where("f <> g")
        nodes = after
        if moved.isEmpty() and unsettled.isEmpty():
            return nodes.select("id", F.col("f").alias("component"))
    raise RuntimeError(f"components did not settle in {ROUNDS_MOST} rounds")
