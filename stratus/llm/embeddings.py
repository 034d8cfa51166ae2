"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors of cosine c or more lie within squared distance 2 - 2c.  Vectors
are rotated (random signs, then a Hadamard transform, which spreads the variance
evenly) and split into blocks of ``BLOCK`` dimensions; a pair within the total
budget is, in some block, within that block's share of it.  Each block is a
range join: its first two coordinates are cut into cells as wide as the block's
radius, a vector goes to its own cell and to half of the neighbouring ones, and
vectors that meet are compared on the block.  A pair is verified (cosine of the
given vectors, in double precision) in the first block where it is within the
share, so the union over blocks holds each pair once without a shuffle of pairs.

A task returns sums, not pairs: how many others each vector links with, and the
smallest member of its group there; components are joined from those.  Equal
vectors are one vector with a count.  A cell with more than ``TILE`` rows is cut
into tiles of row groups, each pair of groups a tile, so no task holds a large
cell.

Edge cases: vectors that are null, zero or hold null or non-finite components,
and rows with a null label, link with nothing; vectors of different lengths
don't link; rows that repeat a vec_id are vectors of their own, in one component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import graph
from stratus.llm.scratch import Scratch, bounded_broadcast

COSINE = 0.98
BLOCK = 8
TILE = 1024
#: Cells cut into tiles are broadcast up to this many.
MAX_CELLS = 500_000
#: Neighbouring cells probed beside a row's own: half of the eight.
_PROBES = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))
#: Rounding room in block distances; verification is exact.
_ROOM = 1e-9


def rotate(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """Unit rows of ``x``, rotated.  Only elementwise steps, so a vector's result
    does not depend on the rows beside it."""
    n, d = x.shape
    size = 1 << max(0, d - 1).bit_length()
    z = np.zeros((n, size))
    z[:, :d] = x / np.sqrt((x * x).sum(1))[:, None]
    z *= np.where(np.random.default_rng(seed).random(size) < 0.5, -1.0, 1.0)
    half = 1
    while half < size:
        y = z.reshape(n, -1, 2, half)
        z = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, size)
        half *= 2
    return z / np.sqrt(size)


def _blocks(size: int, cosine: float) -> list[tuple[int, int, float]]:
    """(first, end, squared radius) of each block: its share of the dimensions."""
    total = 2 - 2 * cosine
    return [(i, min(i + BLOCK, size), total * (min(i + BLOCK, size) - i) / size)
            for i in range(0, size, BLOCK)]


def _cells(cosine: float):
    """(rid, embedding) -> (rid, cells: block, two coordinates and home flag of each)."""
    def run(batches):
        for b in batches:
            rid = b.column("rid")
            lists = b.column("embedding")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(np.asarray(lists.offsets))
            out = {k: [] for k in ("row", "block", "x", "y", "home")}
            first = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                z = rotate(flat[first[rows, None] + np.arange(d)])
                for k, (lo, hi, r2) in enumerate(_blocks(z.shape[1], cosine)):
                    width = np.sqrt(r2) * (1 + 1e-6) + 1e-12
                    x = np.floor(z[:, lo] / width).astype(np.int64)
                    y = np.floor(z[:, min(lo + 1, hi - 1)] / width).astype(np.int64)
                    for dx, dy in _PROBES:
                        out["row"].append(rows)
                        out["block"].append(np.full(len(rows), k))
                        out["x"].append(x + dx)
                        out["y"].append(y + dy)
                        out["home"].append(np.full(len(rows), dx == dy == 0))
            c = {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}
            order = np.argsort(c["row"], kind="stable")
            c = {k: v[order] for k, v in c.items()}
            cut = np.concatenate(([0], np.cumsum(np.bincount(c["row"].astype(np.int64), minlength=len(rid)))))
            cells = pa.StructArray.from_arrays(
                [pa.array(c["block"], pa.int32()), pa.array(c["x"], pa.int64()), pa.array(c["y"], pa.int64()),
                 pa.array(c["home"].astype(bool))], ["block", "x", "y", "home"])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns)),
                 pa.ListArray.from_arrays(pa.array(cut, pa.int32()), cells)], [*b.schema.names, "cells"])
    return run


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest member of each component of a small graph."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, u, root[v])
        np.minimum.at(new, v, root[u])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _tile(rid, weight, home, part, vectors, block: int, cosine: float):
    """Links of one tile: (rid, linked others, smallest linked-up rid) per linked row.

    Rows of one part are compared among themselves; rows of two parts across.
    """
    z = rotate(vectors)
    blocks = _blocks(z.shape[1], cosine)
    lo, hi, r2 = blocks[block]
    y = z[:, lo:hi]
    norm = (y * y).sum(1)
    groups = [np.flatnonzero(part == p) for p in np.unique(part)]
    a, b = (groups[0], groups[0]) if len(groups) == 1 else groups
    us, vs = [], []
    step = max(1, (1 << 20) // max(1, len(b)))
    for i in range(0, len(a), step):
        s = a[i: i + step]
        near = norm[s, None] + norm[b] - 2 * (y[s] @ y[b].T) <= r2 + 1e-7
        near &= home[s, None] | home[b]
        if len(groups) == 1:
            near &= s[:, None] < b
        p, q = np.nonzero(near)
        us.append(s[p])
        vs.append(b[q])
    u, v = np.concatenate(us), np.concatenate(vs)
    length = np.sqrt((vectors * vectors).sum(1))
    keep = []
    for i in range(0, len(u), 1 << 16):
        p, q = u[i: i + (1 << 16)], v[i: i + (1 << 16)]
        ok = np.ones(len(p), bool)
        for k, (lo, hi, r2) in enumerate(blocks[: block + 1]):
            within = ((z[p, lo:hi] - z[q, lo:hi]) ** 2).sum(1) <= r2 + _ROOM
            ok &= within if k == block else ~within  # the first block that has it
        at = np.flatnonzero(ok)
        cos = (vectors[p[at]] * vectors[q[at]]).sum(1) / (length[p[at]] * length[q[at]])
        keep.append(i + at[cos >= cosine])
    keep = np.concatenate(keep) if keep else np.empty(0, np.int64)
    u, v = u[keep], v[keep]
    n = len(rid)
    order = np.argsort(rid, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    root = rid[order][_roots(n, place[u], place[v])][place]
    links = np.bincount(u, weight[v], n) + np.bincount(v, weight[u], n)
    hit = np.flatnonzero(links > 0)
    return rid[hit], links[hit].astype(np.int64), root[hit]


def _compare(cosine: float):
    """Rows sorted by tile -> links.  A tile may go on in the next batch; at most
    one tile is held."""
    names = ["block", "rid", "n", "home", "part", "embedding"]

    def links(rows: pa.Table):
        vectors = rows.column("embedding").combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = pa.concat_arrays(vectors.chunks)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        get = {k: rows.column(k).to_numpy() for k in names[:5]}
        got = _tile(get["rid"], get["n"].astype(float), get["home"], get["part"],
                    flat.reshape(len(rows), -1), int(get["block"][0]), cosine)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], ["rid", "links", "root"])

    def run(batches):
        held, key = [], None
        for b in batches:
            k = np.stack([b.column(c).to_numpy() for c in ("cell", "low", "high")])
            cut = [0, *(np.flatnonzero((np.diff(k) != 0).any(0)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cut[:-1], cut[1:]):
                if hi == lo:
                    continue
                now = tuple(k[:, lo].tolist())
                if now != key and held:
                    rows = pa.Table.from_batches(held)
                    if len(rows) > 1:
                        yield links(rows)
                    held = []
                key = now
                held.append(b.slice(lo, hi - lo).select(names))
        if held and sum(x.num_rows for x in held) > 1:
            yield links(pa.Table.from_batches(held))

    return run


def near_duplicates(vectors: DataFrame, scratch: Scratch, cosine: float = COSINE, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(label_col).alias("label"), F.col(vec_col).alias("embedding"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
              & F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0))
    # Equal vectors of a label are one, under the smallest id, with a count.
    key = F.xxhash64("label", "embedding")
    good = base.where(usable)
    distinct = scratch.save(
        good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rid"), F.count("*").alias("n")), "distinct")
    placed = (distinct.mapInArrow(_cells(cosine), _schema(distinct))
              .select("rid", "n", "label", "embedding", F.explode("cells").alias("c"))
              .select("rid", "n", "embedding", "c.block", "c.home",
                      F.xxhash64("label", F.size("embedding"), "c.block", "c.x", "c.y").alias("cell")))
    # Large cells: rows in s groups by id, a tile for each pair of groups.
    large = scratch.save(
        placed.groupBy("cell").agg(F.count("*").alias("rows")).where(F.col("rows") > TILE)
        .select("cell", F.ceil(F.col("rows") / TILE).cast("int").alias("s")), "large")
    part = F.pmod(F.xxhash64("rid"), F.coalesce("s", F.lit(1))).cast("int")
    tiled = (placed.join(bounded_broadcast(large, MAX_CELLS), "cell", "left").withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("s", F.lit(1)) - 1)))
             .select("cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                     "block", "rid", "n", "home", "part", "embedding"))
    found = scratch.save(
        tiled.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "rid")
        .mapInArrow(_compare(cosine), "rid long, links long, root long"), "found")
    whole = graph.components(found.select(F.col("rid").alias("u"), F.col("root").alias("v")), scratch)
    # Written first: a vector with very many copies is then a plain skewed join.
    per = scratch.save(distinct.select("label", "embedding", "rid", "n")
           .join(found.groupBy("rid").agg(F.sum("links").alias("links")), "rid", "left")
           .join(whole.withColumnRenamed("node", "rid"), "rid", "left")
           .select(key.alias("key"), F.col("label").alias("_label"), F.col("embedding").alias("_vec"),
                   (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                   F.coalesce("component", "rid").alias("component_id")), "per")
    linked = (good.withColumn("key", key)
              .join(per, "key").where("label = _label AND embedding = _vec")
              .select("vec_id", "n_links", "component_id"))
    alone = base.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _schema(distinct: DataFrame) -> str:
    kinds = ", ".join(f"`{c}` {t}" for c, t in distinct.dtypes)
    return f"{kinds}, cells array<struct<block:int,x:bigint,y:bigint,home:boolean>>"
