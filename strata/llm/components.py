"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns a, b), where
    root is the least node reachable.

    Alternates the large-star and small-star steps (Kiveris et al., Connected
    Components in MapReduce and Beyond, 2014) until the edges stop changing;
    each round is written, so a lost executor never replays more than one
    round. A hub's minimum is folded map-side; the join back is an inner
    sort-merge join on the hub, which AQE splits. Self loops, repeated edges
    and NULL ends are ignored. Only one row of totals reaches the driver.
    """
    now = stored(_clean(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "components")
    seen = _totals(now)
    while seen[0]:
        now = stored(_star(_star(now, large=True), large=False), "components")
        new = _totals(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _clean(edges: DataFrame) -> DataFrame:
    """Undirected edges once, as a < b."""
    return edges.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour of a node to its least neighbour
    (itself included). Small star: link every smaller neighbour, and the node
    itself, to the least one. ``edges`` hold a < b."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("u", "m").alias("m")
        )
        linked = around.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("c"))
        return _clean(linked.select(F.col("v").alias("a"), F.col("m").alias("b")))
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("c"), "m")
    linked = edges.join(least, F.col("b") == F.col("c"))
    return _clean(
        linked.select(F.col("a"), F.col("m").alias("b")).unionByName(least.select(F.col("c").alias("a"), F.col("m").alias("b")))
    )


def _totals(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set that does not depend on row order."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(x or 0 for x in row)
