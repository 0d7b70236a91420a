"""Connected components of links between numbered nodes, by alternating stars.

Every round attaches each node's larger neighbours to its smallest one, then each node's
smaller neighbours to the smallest, which keeps components as they are, shortens paths at
least by half and ends when every node hangs on its component's smallest number. A round
groups by node with a minimum only, so a node with very many links is combined before the
shuffle, and each round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """links: a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def smallest_reachable(links: DataFrame) -> DataFrame:
    """From links (a, b), one row (a, b) per node that can reach a smaller one: b is the smallest.

    Null ends and links of a node to itself count for nothing; repeated links count once; no
    links give no rows.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current = materialise(ordered, "links")
    state = _state(current)
    while state[0]:
        current = materialise(_small_star(_large_star(current)), "links")
        after = _state(current)
        if after == state:
            break
        state = after
    return current
