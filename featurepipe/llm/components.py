"""Connected components of a graph of links, by large-star and small-star steps on tables.

Each round rewrites the links so that nodes hang on smaller ones, and is written to the shared folder; the rounds
grow with the logarithm of the longest path. Minima are pre-aggregated in the tasks, so a hub costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.sources.staging import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node of the component."""
    a, b = F.col("a"), F.col("b")
    stars = materialize(
        links.where(a != b)
        .select(F.when(a > b, a).otherwise(b).alias("hi"), F.when(a > b, b).otherwise(a).alias("lo"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        found = stars.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
        stars = materialize(_small_star(_large_star(stars)), "links")
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)


def _large_star(stars: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour, or to itself."""
    both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.where("v > u").join(least, "u")
    low = F.when(F.col("m") < F.col("u"), F.col("m")).otherwise(F.col("u"))
    return moved.select(F.col("v").alias("hi"), low.alias("lo")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = stars.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = stars.join(least, "hi")
    moved = joined.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
