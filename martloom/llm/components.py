"""Connected components of a graph of links, by repeated contraction in Spark joins; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): equal roots mean connected. Empty without links.

    Every round joins each node to the smallest node among itself and its neighbours and contracts the links to those,
    until none is left. Sums per node are combined before the shuffle, so a node with very many links is no hot spot.
    """
    rest = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    found = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "least")
        if found is None:
            found = least
        else:
            step = least.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        left = least.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = least.select(F.col("node").alias("b"), F.col("root").alias("y"))
        contracted = rest.join(left, "a").join(right, "b").filter("x <> y")
        rest = stored(contracted.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return stored(found, "components")
