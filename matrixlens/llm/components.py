"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matrixlens.llm.tables import discard, hand_on, scratch, written

#: Rounds after which something must be wrong; each at least halves the longest chain.
MOST_ROUNDS = 60


def _signature(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    one = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(one)


def connected_components(links: DataFrame) -> DataFrame:
    """From links (a, b) of longs to (node, root), root the smallest node of the component.

    Alternates large and small stars: a node hands its smallest neighbour to the others, until
    every node hangs on its root.  Each step is one aggregation, combined before the shuffle,
    and one join; the links of a round are written once, and only a count comes to the driver.
    """
    spark = links.sparkSession
    with scratch(spark) as folders:
        links = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = _signature(links)
        for _ in range(MOST_ROUNDS):
            both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            # Large star: larger neighbours of a node go to the smallest of its neighbours and itself.
            smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = written(large.distinct())
            # Small star: smaller neighbours of a node, and itself, go to the smallest of them.
            lowest = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
            links = written(small.distinct())
            before, now = now, _signature(links)
            if now == before:
                hand_on(folders)
                break
            while len(folders) > 1:
                discard(spark, folders.pop(0))
        else:
            raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
