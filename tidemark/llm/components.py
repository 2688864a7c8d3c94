"""Connected components of a link table, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) of every node that has a link to another.

    Large-star and small-star steps in turn: each hangs neighbours on the smallest one known, so that every
    component ends as one star around its smallest node after a number of rounds logarithmic in its size. Minima
    are partial aggregates, a hub's links are never gathered in one place, and each round is written out, so lost
    executors cost one round. Links with a null end and links to itself are left out.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = saved(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(lower.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = saved(small)
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres).distinct()
