"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) and a join that
adaptive execution may split, so a node linked to a third of all others stays
spread over tasks. Links never pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.llm.common import save


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over rows (a, b) with a > b: neighbours of a node move to its smallest one."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.join(least, "a")
    if large:  # every larger neighbour links to the smallest of the node and its neighbours
        out = joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:  # smaller neighbours, and the node itself, link to the smallest neighbour
        out = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select("a", F.col("m").alias("b"))))
    return out.where("a > b").distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), b <> a; root is the smallest node reachable.

    Nodes without a link are not returned. Repeated and reversed links are fine.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = save(links, "links")
    mark = _mark(links)
    while mark[0]:
        links = save(_star(_star(links, large=True), large=False), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
