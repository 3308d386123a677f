"""Connected components of a table of links, by stars that merge, without collecting any node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _toward_least(links: DataFrame, keep: str) -> DataFrame:
    """Link what ``keep`` selects of each node's neighbours to the least of them and the node."""
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return links.join(least, "a").where(keep).select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node that ``a`` and ``b`` link, roots left out.

    Every round ties the larger neighbours of each node to its least one, then the smaller ones; hubs are
    joined to their minimum, not gathered. Rounds grow with the logarithm of a component's width.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _toward_least(both, "b > a")
        # Larger to smaller; the node itself goes to the least as well.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("x")).select("x.a", "x.b")
        links = stored(small.where("a <> b").distinct())
        now = _state(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
