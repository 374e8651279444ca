"""Connected components of a graph given by its edges, by star contraction.

Each round reconnects every node's larger neighbours to its smallest one, then every node and its smaller
neighbours to the smallest of them, until all edges point to their component's smallest node. Both steps
are joins with a grouped minimum: no neighbourhood is gathered, and the edges are written to the shared folder in
each round. A round reads them in as few tasks as their number needs, ``EDGES_PER_TASK`` each; up to so many lie in one
task and are joined and grouped there without any exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.session import checkpointed


EDGES_PER_TASK = 200_000


def _packed(edges: DataFrame, state: tuple) -> DataFrame:
    return edges.coalesce(max(1, -(-state[0] // EDGES_PER_TASK)))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it reaches, for all nodes of edges (``a``, ``b``) but the labels.

    Nodes may be of any ordered type; loops, repeated edges and edges with a null end do not count. Without
    edges the result is empty.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = checkpointed(edges.distinct())
    state = _state(edges)
    while True:
        edges = _packed(edges, state)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.where("b > a").join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # edges to the smallest neighbour are no larger neighbours of anything else
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"))
        edges = checkpointed(small.where("a <> b").distinct())
        after = _state(edges)
        if after == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        state = after
