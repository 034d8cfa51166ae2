"""Connected components as iterated joins (alternating large-star, small-star).

Each round rewrites the edge list so that nodes point at smaller neighbours; it
ends when every node points at its component's smallest node.  The edge list is
written to the shared folder each round (no growing lineage) and never reaches
the driver: only its size and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch


def _star(edges: DataFrame, large: bool, scratch: Scratch, name: str) -> DataFrame:
    """Large star: each node's larger neighbours point at its smallest
    neighbour-or-self.  Small star: its smaller neighbours and itself do.

    The minima are written first, so that both join sides are plain shuffles,
    which AQE can split where a node has very many neighbours.
    """
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")), name)
    out = both.join(least, "u")
    if large:
        out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for nodes with an edge.

    ``edges`` has two integer columns ``u`` and ``v``; direction, repeats and
    self-loops don't matter.
    """
    now = scratch.save(edges.where("u <> v").select("u", "v").distinct(), f"{name}-0")
    state, k = _state(now), 0
    while state[0]:
        k += 1
        mid = scratch.save(_star(now, True, scratch, f"{name}-least-{k}a"), f"{name}-{k}a")
        nxt = scratch.save(_star(mid, False, scratch, f"{name}-least-{k}b"), f"{name}-{k}")
        new = _state(nxt)
        scratch.drop(f"{name}-{k - 1}", f"{name}-{k}a", f"{name}-least-{k}a", f"{name}-least-{k}b")
        if new == state:
            break
        now, state = nxt, new
    now = nxt if k else now
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
