"""Connected components of a link table, in Spark rounds.

Alternating star contraction: in a round every node looks up the smallest of
itself and its neighbours and hands it to its larger neighbours (large star),
then to its smaller ones (small star).  Rounds grow with the logarithm of the
longest chain.  Each round's links are written to the shared folder, so a lost
executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """links (u, v) with u > v -> contracted links."""
    if larger:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    out = met.where(F.col("v") > F.col("u")) if larger else met
    moved = out.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger:
        moved = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return (moved.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (node, root): every node that has a link and
    the smallest node it reaches."""
    level = shared_table(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        state = tuple(level.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                                F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            break
        before = state
        level = shared_table(_star(_star(level, True), False), "links")
    roots = level.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return level.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
