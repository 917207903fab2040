"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


#: Links for each partition, and the least number of partitions.
_LINKS, _LEAST = 200_000, 8


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Nodes and the smallest node that each can reach, from links (a, b) in either direction.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then
    hands its smaller neighbours to the smallest of them. The number of rounds grows with the logarithm of the
    longest path. Links stay distributed; only a count and a checksum reach the driver. Links with a null end and
    links of a node to itself are ignored; nodes without other links are not in the result. Links are few beside the
    documents they come from, so they are kept in as many partitions as they fill, whatever the shuffle's number is.

    Columns: node, root.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("ok"))
    links = settle(links.where("ok").select("a", "b").distinct())
    seen = _print_of(links)
    while True:
        parts = _LEAST + seen[0] // _LINKS
        links = links.coalesce(parts)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low.coalesce(parts), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = settle(large.coalesce(parts).distinct().coalesce(parts))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low.coalesce(parts), "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        named = low.select("a", F.col("low").alias("b"))
        links = settle(small.coalesce(parts).unionByName(named.coalesce(parts)).distinct().coalesce(parts))
        now = _print_of(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
