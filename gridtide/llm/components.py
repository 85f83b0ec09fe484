"""Connected components of a table of links, by alternating stars.

Each round hangs every larger neighbour of a node on the smallest node it knows, then does the same for
the smaller ones. Rounds go on until the links are stars: a number of rounds logarithmic in the size of
the largest component. Each round's links and minima are tables in the shared folder, deleted once the next round's are written: a lost
executor costs a task, not the lineage, and joins of plain tables let Spark split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import durable, release


def _smallest(links: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours: far, low."""
    low = links.groupBy("far").agg(F.min("near").alias("low"))
    return durable(low.select("far", F.least("far", "low").alias("low")), "minima")


def _state(links: DataFrame):
    return links.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("far", "near")), F.bit_xor(F.hash("near", "far").cast("long"))
    ).first()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """One row per linked node: node, component (its smallest node). Loops and repeats in `links` are harmless."""
    stars = durable(
        links.select(F.greatest(a, b).alias("far"), F.least(a, b).alias("near")).where("far > near").distinct(),
        "links",
    )
    before = _state(stars)
    while before[0]:
        both = stars.union(stars.select("near", "far"))
        lows = _smallest(both)
        large = (
            both.where("near > far").join(lows, "far")
            .select(F.col("near").alias("far"), F.col("low").alias("near")).distinct()
        )
        large = durable(large, "large-stars")
        minima = _smallest(large)
        small = (
            large.join(minima, "far").where("near <> low").select(F.col("near").alias("far"), F.col("low").alias("near"))
            .union(minima.where("far <> low"))
        )
        former, stars = stars, durable(small.distinct(), "stars")
        release(former, lows, large, minima)
        after = _state(stars)
        if tuple(after) == tuple(before):
            break
        before = after
    centres = stars.select("near").distinct()
    return stars.select(F.col("far").alias("node"), F.col("near").alias("component")).union(
        centres.select("near", F.col("near"))
    )
