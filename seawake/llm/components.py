"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b): the smallest id that can be reached.

    Large-star and small-star rounds in turn: links are re-hung to smaller neighbours until nothing changes, which
    takes a number of rounds that grows with the logarithm of the longest chain. Each round is written to the shared
    folder, so lineage stays short. Only a count and a checksum reach the driver.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(smallest.withColumnRenamed("m", "v")).distinct(), "links")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == seen:
            break
        seen = now
    ends = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("id"), "component")).distinct()
