"""Connected components of a table of links, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.session import durable


def _pull(links: DataFrame, least: DataFrame) -> DataFrame:
    """Links ``(u, v)`` with the least neighbour of ``u``; both sides are plain tables, so a hot ``u`` can be split."""
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node with a link.

    ``links``: columns ``a, b``, integers without nulls. Large stars point the
    larger neighbours of a node to its least one, small stars the smaller ones;
    repeated until nothing changes, which takes a number of rounds that grows with the
    logarithm of a component's size. Every round is written, so no lineage grows
    and no link passes through the driver; it sees one count and one checksum. Repeated
    links and loops do no harm; no links give an empty table.
    """
    current = durable(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = (_pull(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                 .union(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct())
        large = durable(large, "large")
        least = durable(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (_pull(large, least).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        current = durable(small, "small")
        seen = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if (seen.n, seen.h) == state or not seen.n:
            break
        state = (seen.n, seen.h)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
