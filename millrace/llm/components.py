"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """Every ``(u, v)`` with the smallest node next to ``u``, itself included."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the undirected links; the root is the smallest.

    Links with a null end and loops join nothing. Each round is two joins on nodes and is
    stored, so a lost executor repeats at most one round; the number of rounds grows with
    the logarithm of the longest path.
    """
    edges = materialize(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _to_smallest(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).distinct()
        small = _to_smallest(down)
        nxt = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))
        ).filter("a <> b").distinct()
        edges = materialize(nxt, "links")
        last, state = state, _state(edges)
        if state == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
