"""Connected components of links between numbered nodes, without gathering any group in a task."""

from pyspark.sql import functions as F

from tarmac.llm.common import drop, stored


def connected(links):
    """(node, root) for every node of `links` (a, b), root being the smallest node it reaches.

    Large-star and small-star steps in turn: nodes hang on the smallest node they know until every
    component is a star. Minima are aggregated by key and joined back, so a node with any number
    of links is a skewed key of a join, not a group in memory. Steps go on until none changes a link;
    their number grows with the logarithm of the longest chain. Of the tables of the rounds only the one returned stays.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                   .where("node <> root").distinct(), "links")
    state = None
    while True:
        both = edges.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
            edges.select(F.col("root").alias("a"), F.col("node").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("u"), F.least("a", "low").alias("low"))
        large = (both.join(least, F.col("a") == F.col("u")).where("b > a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct())
        large = stored(large, "large-star")
        drop(edges)
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u"))
        edges = stored(small.select(F.col("a").alias("node"), F.col("low").alias("root")).unionByName(
            small.select(F.col("b").alias("node"), F.col("low").alias("root")))
            .where("node <> root").distinct(), "small-star")
        drop(large)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
                        .alias("sum")).first()
        if state == now:
            break
        state = now
    return edges
