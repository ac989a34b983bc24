"""Connected components of a link table, by repeated joins and minima only.

Each round does a large-star and a small-star step: links between a node and its
larger neighbours move to the node's smallest neighbour, until every node links to
the smallest node of its component. Rounds grow with the logarithm of the longest
path. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import written


def _both(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(sides: DataFrame, own: bool) -> DataFrame:
    """Each neighbour b of a with the least neighbour of a, a itself counting if ``own``."""
    least = F.least(F.min("b"), F.col("a")) if own else F.min("b")
    # stored, so that the join has plain scans on both sides and can split a node of many links
    return sides.join(written(sides.groupBy("a").agg(least.alias("least")), "least"), "a").select("a", "b", "least")


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def smallest(links: DataFrame) -> DataFrame:
    """``links`` (a, b) between ordered ids -> (id, least) for every id but the least of each component."""
    # b < a throughout: a hangs below b
    now = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(now)
    while state[0]:
        large = _stars(_both(now), True).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = _stars(written(large.distinct(), "links"), False)
        small = (
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionAll(small.select("a", F.col("least").alias("b")))
            .where("a > b")
            .distinct()
        )
        now = written(small, "links")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("least"))
