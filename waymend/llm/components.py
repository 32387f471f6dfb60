"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.llm.common import staged


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node of it) for every node of ``links`` (a, b: long).

    Each round every node hands its smallest neighbour to its larger ones, then to its smaller
    ones (both are one aggregate and one join), until nothing changes.
    """
    now = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = (
            large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        )
        now = staged(stars)
        r = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(r) == mark:
            break
        mark = tuple(r)
    else:
        raise RuntimeError("components did not settle")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
