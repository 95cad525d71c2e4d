"""Connected components of a graph given as a table of links, by repeated contraction.

In each round every node points to its smallest neighbour in an order that changes with the
round, pointers are followed one step, and links are drawn between what is left. The order
is hashed, so a long chain loses a constant share of its nodes per round. All rounds are
joins and aggregations over written tables; nothing is collected but counts of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (columns ``a``, ``b``, long): one root per component."""
    edges = written(links.where("a <> b").select("a", "b").distinct(), "links")
    roots = None
    turn = 0
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda name: F.xxhash64(F.lit(turn), F.col(name))  # noqa: B023,E731
        nearest = both.groupBy("a").agg(F.min_by("b", rank("b")).alias("b"))
        pointers = written(
            nearest.select(
                F.col("a").alias("node"), F.when(rank("b") < rank("a"), F.col("b")).otherwise(F.col("a")).alias("to")
            ),
            "pointers",
        )
        # Every node of a link has a pointer, so the join is complete.
        step = pointers.select(F.col("node").alias("to"), F.col("to").alias("further"))
        pointers = written(pointers.join(step, "to").select("node", F.col("further").alias("to")), "pointers")
        target = lambda name: pointers.select(F.col("node").alias(name), F.col("to").alias(f"{name}_to"))  # noqa: B023,E731
        edges = written(
            edges.join(target("a"), "a")
            .join(target("b"), "b")
            .where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            "links",
        )
        if roots is None:
            roots = pointers.select("node", F.col("to").alias("root"))
        else:
            moved = pointers.select(F.col("node").alias("root"), F.col("to").alias("moved"))
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("moved", "root").alias("root"))
        roots = written(roots, "roots")
        turn += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
