"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import landed


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component, the smallest node it reaches, for every node in `links` (a, b).

    Every round hangs each node's neighbours on the smallest of them and of the node itself, first for larger neighbours,
    then for smaller ones, so paths shorten by a half or more. Each round's links are written, which cuts the lineage;
    a hub's links are summed in every task before they move. Stops when nothing changes.
    """
    both = lambda df: df.select("a", "b").union(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
    stars = landed(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        least = _least(both(stars))
        large = both(stars).join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = landed(large.where("a <> b").distinct(), "large_stars")
        small = large.join(_least(large), "a").select("a", "b", "least")
        moved = small.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        after = landed(moved.union(small.select("a", F.col("least").alias("b"))).distinct(), "stars")
        if _print(after) == _print(stars):
            break
        stars = after
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    own = stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return own.union(roots)


def _print(links: DataFrame) -> tuple:
    """Number and digest of a set of links."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
