"""Connected components of a graph given as links, by alternating large and small stars.

Each round links every node to the least node among its neighbours, first across its larger, then
across its smaller neighbours, until every component is one star around its least node. The number
of rounds grows with the logarithm of the longest chain. Links never pass through the driver. Each
round is written to the shared folder, so a lost executor costs a re-read, and minima are written
before they are joined back, so that Spark can split the rows of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.storage import written


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _least(edges: DataFrame) -> DataFrame:
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "least").withColumnRenamed("u", "n")


def stars(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots; links has two columns of ids, a and b.

    Links of a node to itself and repeated links change nothing. No links give no rows.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while (now := _digest(edges)) != before and now[0]:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = written(
            both.join(least, F.col("u") == F.col("n"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct(),
            "large",
        )
        least = _least(large)
        inner = large.join(least, F.col("u") == F.col("n")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(inner.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
