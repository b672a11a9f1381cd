"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textpulse.llm.common import discard, stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Each edge (a, b) with m, the least of a and all its neighbours b.

    The minimum is aggregated in the map tasks; a hub's edges then meet one row in a plain
    join, which adaptive execution can split.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least.select("a", F.least("a", "m").alias("m")), "a")


def components(links: DataFrame) -> DataFrame:
    """(node, root): root is the least node that links lead to from node.

    ``links`` has columns a and b, any order, repetitions allowed. Nulls and self-links are no
    links; nodes without a link are not returned; an empty table gives an empty one.

    Alternates large-star and small-star steps (Kiveris et al., 2014): every node hangs on the
    least node it knows until nothing moves, in a number of rounds logarithmic in practice. A
    round is written to the shared folder, so a lost executor repeats at most one round.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least_neighbour(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").distinct()
        small = _least_neighbour(down)
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        following = stage(small)
        # Equal edge sets have equal sums; each round only moves edges to smaller ends.
        state = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(edges)
        edges = following
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
