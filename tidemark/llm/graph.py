"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import pin


def _state(edges: DataFrame) -> tuple:
    """Tells two edge tables apart without reading them on the driver."""
    pair = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(pair)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root being the least node.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its least one, then its smaller neighbours and itself.  A step is
    a minimum for each node, combined before the shuffle, and a join that Spark can
    split where a node has very many links.  Each round is written to the shared
    folder; the driver sees a count and a sum.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = pin(
        links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        # Towards larger neighbours: a is the smaller end throughout.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # v > u goes to m(u): the edges as (u = a, v = b).
        large = edges.join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Towards smaller neighbours: each b to its least a, and its other ones too.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
            .unionByName(low.select(F.col("m").alias("x"), F.col("b").alias("y")))
            .where("x <> y")
        )
        edges = pin(
            small.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
        last, state = state, _state(edges)
        if last == state:
            break
    # Every edge now ends in the root.
    return (
        edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")))
        .distinct()
    )
