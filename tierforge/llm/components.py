"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import stored
from tierforge.operators.lookup import spread


def _least(edges: DataFrame) -> DataFrame:
    """Every edge ``(a, b)`` with ``m``, the least of ``a`` and all its neighbours.

    The least neighbours are found map side first and joined back. Both sides of the join are
    shuffled, so that the edges of a node with very many neighbours can be split; neither is broadcast.
    """
    neighbours = edges.groupBy("a", spread("a")).agg(F.min("b").alias("least")).select("a", "least")
    return edges.join(neighbours.hint("merge"), "a").select("a", "b", F.least("a", "least").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (least node reachable) of every node in ``edges`` (``a``, ``b`` long).

    Alternates two steps until nothing changes, which takes about log(nodes) rounds: each
    node links its larger neighbours, then its smaller ones, to the least of them. The
    number of edges never grows. Every round is written to the shared checkpoint folder;
    only the number and a checksum of the edges reach the driver.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # From here on a > b in every edge.
        small = _least(large)
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        current = stored(small.where("a <> b").distinct(), "edges")
