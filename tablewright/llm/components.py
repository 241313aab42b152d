"""Connected components of a graph that may have hubs, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import stage


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum("low"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable (``low``) from every ``node`` that has a link and is not smallest itself.

    ``links`` has columns ``a`` and ``b``. Alternates large stars (neighbours above a node are linked to the smallest
    node around it) and small stars (the same for those below), which keeps the number of links and ends
    after a number of rounds that grows with the logarithm of the longest path. Every round is written to the shared
    folder; a hub is a hot key of a join, which adaptive execution splits.
    """
    node, low = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")
    now = stage(links.where("a <> b").select(node, low).distinct(), "links")
    state = _state(now)
    while state[0]:
        around = now.union(now.select(F.col("low"), F.col("node")))
        smallest = around.groupBy("node").agg(F.least(F.col("node"), F.min("low")).alias("smallest"))
        large = around.where("low > node").join(smallest, "node")
        large = large.select(F.col("low").alias("node"), F.col("smallest").alias("low")).distinct()
        below = large.groupBy("node").agg(F.min("low").alias("smallest"))
        small = large.join(below, "node").where("low <> smallest").select(F.col("low").alias("node"), "smallest")
        both = small.union(below.select("node", "smallest")).withColumnRenamed("smallest", "low")
        now = stage(both.distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now
