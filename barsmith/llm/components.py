"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.session import scratch_table


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of bigint nodes to (node, root), without the roots themselves.

    The root is the smallest node reached. Each round first hangs a node's larger neighbours
    under its smallest one, then its smaller neighbours; the rounds needed grow with the
    logarithm of the longest path. A round is two aggregations and joins back, written to
    the shared folder; no node's neighbours are gathered into a list.
    """
    edges = scratch_table(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b"))
            )
        ).distinct()
        edges = scratch_table(small, "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
