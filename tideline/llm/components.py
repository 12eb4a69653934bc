"""Connected components by alternating star operations, on tables of edges.

Each round rewrites the edges so that they point at smaller ids (first from the
larger neighbours of every node, then from the smaller ones) and ends as a
table in the shared folder. A few rounds suffice whatever the depth of the
graph: their number grows with the square of the logarithm of its size. Only a
count and a checksum of the edges reach the driver.

A node with more than ``HEAVY_ROWS`` edges (and a ten-thousandth of all) would
have them meet in one task of the join. There are at most 10,000 of them, so
their least neighbours are sent to the edges instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import written

MOST_ROUNDS = 60
HEAVY_ROWS = 1_000_000
HEAVY_SHARE = 10_000


def _point_at_least(edges: DataFrame, total: int) -> DataFrame:
    """Each edge (u, v) becomes (v, m) with m the least of u and its listed neighbours; u itself points at m.

    ``total`` is at least the number of edges: with few there is no heavy node and nothing is counted.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    if total <= HEAVY_ROWS:
        moved = edges.join(least.drop("n"), "u")
    else:
        least = written(least, "least")
        heavy = F.broadcast(least.filter(F.col("n") > max(HEAVY_ROWS, total // HEAVY_SHARE)).drop("n"))
        rest = edges.join(heavy.select("u"), "u", "left_anti").join(least.drop("n"), "u")
        moved = rest.unionByName(edges.join(heavy, "u"))
    return moved.select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))
    )).alias("e")).select("e.*")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for each node of the edges ``(u, v)``; root is the least id of its component.

    Loops and null ends are ignored; a node without edges is not in the result.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = written(edges, "edges"), None
    total = 2 * edges.count()
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours move to the least one; the node's own edge is kept by the small side below.
        large = _point_at_least(both, total).filter("u > v").distinct()
        small = _point_at_least(large, 2 * total).filter("u > v").distinct()
        edges = written(small, "edges")
        state = _state(edges)
        total = 2 * state[0]
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select("u", F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
