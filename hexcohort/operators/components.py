"""Connected components of an undirected graph by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort.sources.scratch import materialize


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, comp)`` where ``comp`` is the smallest node name of the component.

    ``nodes(node)`` lists every node, ``edges(a, b)`` each link once in any
    direction.  A round hangs every root below its smallest neighbouring root,
    follows the hooks to their ends, and contracts the links to the new roots;
    each step is written out, so lineage stays short.  Taking one minimum per
    root folds on the map side, which takes the weight off hub nodes.  Each
    round at least halves the roots that still have links, so the number of
    rounds grows with the logarithm of the graph.
    """
    comp = materialize(nodes.select("node", F.col("node").alias("comp")), "cc")
    links = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    links = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc")
    for _ in range(max_rounds):
        if links.isEmpty():
            return comp
        hook = materialize(links.filter(F.col("b") < F.col("a")).groupBy(F.col("a").alias("root"))
                           .agg(F.min("b").alias("up")), "cc")
        hook = _flatten(hook)
        comp = materialize(comp.join(hook.withColumnRenamed("root", "comp"), "comp", "left")
                           .select("node", F.coalesce("up", "comp").alias("comp")), "cc")
        links = (links.join(hook.select(F.col("root").alias("a"), F.col("up").alias("ua")), "a", "left")
                 .join(hook.select(F.col("root").alias("b"), F.col("up").alias("ub")), "b", "left")
                 .select(F.coalesce("ua", "a").alias("a"), F.coalesce("ub", "b").alias("b")))
        links = materialize(links.filter(F.col("a") != F.col("b")).distinct(), "cc")
    raise RuntimeError("components did not settle")


def _flatten(hook: DataFrame) -> DataFrame:
    """Follow the hooks (always to a smaller name) until every root points at its last one."""
    while True:
        nxt = hook.select(F.col("root").alias("up"), F.col("up").alias("up2"))
        step = materialize(hook.join(nxt, "up", "left")
                           .select("root", F.coalesce("up2", "up").alias("up"), F.col("up2").isNotNull().alias("moved")),
                           "cc")
        hook = step.select("root", "up")
        if step.filter("moved").isEmpty():
            return hook
