"""Connected components of an edge table, by DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node reachable.

    Each round every node points at the smallest among itself and its
    neighbours, pointers are followed, three at a time, until each names the root
    of its tree, and the trees are contracted: an edge between two trees becomes
    an edge between their roots. Every tree has two nodes or more, so a round at least halves the
    nodes; rounds and steps both grow with the logarithm of the input, and
    later rounds work on ever smaller tables. Minima are pre-aggregated, so a
    hub with very many links is a row for each map task. All tables of a round
    are written to the shared folder and removed when the result is there.
    """
    scratch = Scratch(edges.sparkSession)
    both = scratch.store(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                         .where("a <> b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while True:
        up = scratch.store(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")).withColumnRenamed("a", "node"), "up")
        moved = 1
        while moved:
            one, two = (up.select(F.col("node").alias(f"via_{i}"), F.col("up").alias(f"up_{i}")) for i in (1, 2))
            further = scratch.store(up.join(one, F.col("up") == F.col("via_1")).join(two, F.col("up_1") == F.col("via_2"))
                                    .select("node", F.col("up").alias("was"), F.col("up_2").alias("up")), "up")
            moved = further.where("up <> was").limit(1).count()
            up = further.select("node", "up")
        rounds.append(up)
        at_a, at_b = (up.select(F.col("node").alias(f"node_{x}"), F.col("up").alias(f"up_{x}")) for x in "ab")
        both = scratch.store(both.join(at_a, F.col("a") == F.col("node_a")).join(at_b, F.col("b") == F.col("node_b"))
                             .select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).where("a <> b").distinct(), "edges")
        if not both.limit(1).count():
            break
    roots = rounds.pop().withColumnRenamed("up", "root")
    while rounds:                               # smallest tables first
        below = rounds.pop()
        above = roots.select(F.col("node").alias("via"), "root")
        roots = below.join(above, F.col("up") == F.col("via"), "left").select("node", F.coalesce("root", "up").alias("root"))
    result = stored(roots, "components")
    scratch.drop()
    return result
