"""The prefix trie of conversations, from ternary search trees per range shard.

Turns (role, text) are dictionary-encoded: every distinct turn gets an integer,
so that a conversation is a short array and texts are shuffled once.  The arrays
are range-partitioned and sorted (equal ones by conversation id, so that copies
of one conversation spread over shards like any other rows).  Each shard puts its
distinct sequences into a ternary search tree, medians first, which keeps the
trees of siblings balanced on sorted input; a node of the ``eq`` links is a
prefix.  A loop over the nodes, last made first, sums members, leaves and savings
up the tree without recursion.

A prefix is in several shards only if it begins the first sequence of one of them
and the last of the one before.  Two numbers per shard, the common prefix lengths
with its neighbours, therefore say which nodes are on the boundary.  They also
say who counts what: a node's bytes count in the first shard that holds it, a
leaf in the last, so the sums of boundary nodes over shards are plain additions.
All other nodes are final as they leave their shard.

Edge cases: a null conversation id is no conversation; null roles and texts are
empty.  Turns are ordered by number, nulls first, equal numbers by role and text;
repeated rows are repeated turns.  No rows give no nodes, not even a root.  Other
columns are ignored.  A single conversation's turn numbers (24 bytes a turn, not
its texts) must fit a task; nothing else that grows is held by one.
"""

from __future__ import annotations

import hashlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.scratch import MAX_BROADCAST, Scratch, bounded_broadcast

#: Turns (and conversations) in a shard, about.
SHARD_TURNS = 100_000
#: A turn of more than this share of all rows is hot; there are fewer than its
#: reciprocal, so they are broadcast.
HOT_SHARE = 1000


# --- sequences -------------------------------------------------------------
def encoded(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, ids, sizes) per conversation: its turns' dictionary numbers and
    the UTF-8 lengths of their texts, in order.

    The order comes from one range-partitioned sort, so a conversation with many
    turns is sorted by several tasks.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    turns = scratch.save(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", F.monotonically_increasing_id().alias("place"), F.unhex(F.sha2(said, 256)).alias("turn"),
            F.octet_length("text").cast("long").alias("size")), "turns")
    words = scratch.save(
        turns.groupBy("turn").agg(F.count(F.lit(1)).alias("n")).select(
            "turn", F.monotonically_increasing_id().alias("id"), "n"), "dictionary")
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(words.where(F.col("n") * HOT_SHARE > total).select("turn", "id"))
    numbered = turns.join(hot, "turn").unionByName(
        turns.join(hot, "turn", "left_anti").join(words.select("turn", "id"), "turn"))
    return numbered.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "size"))).alias("_t")).select(
        "conv_id", F.col("_t.id").alias("ids"), F.col("_t.size").alias("sizes"))


def regrafted(seqs: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation
    c - c % ``every``; h = crc32(decimal c) % ``most``."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % most).cast("int")
    heads = seqs.where(c % every == 0).select(
        c.alias("_base"), F.slice("ids", 1, most - 1).alias("_ids"), F.slice("sizes", 1, most - 1).alias("_sizes"))
    both = seqs.withColumn("_h", h).join(heads, (c - c % every) == F.col("_base"), "left")

    def graft(own: str, head: str) -> Column:
        none = F.array().cast("array<bigint>")
        start = F.slice(F.coalesce(F.col(head), none), F.lit(1), F.col("_h"))
        rest = F.slice(F.col(own), F.col("_h") + 1, F.size(own) + 1)
        return F.concat(start, rest).alias(own)

    return both.select("conv_id", graft("ids", "_ids"), graft("sizes", "_sizes"))


# --- one shard -------------------------------------------------------------
class TernaryTree:
    """Prefix nodes of integer sequences; node 0 is the root.

    ``eq`` leads to the tree of a prefix's continuations, ``lo`` and ``hi`` to
    siblings with smaller and larger last elements.  A node is always made after
    its parent prefix.
    """

    def __init__(self):
        self.key, self.parent, self.depth = [0], [-1], [0]
        self.lo, self.hi, self.eq = [-1], [-1], [-1]

    def _new(self, key: int, parent: int) -> int:
        for column, value in ((self.key, key), (self.parent, parent), (self.depth, self.depth[parent] + 1),
                              (self.lo, -1), (self.hi, -1), (self.eq, -1)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, seq: list[int]) -> list[int]:
        """Add a sequence; returns its prefixes' nodes, the root first."""
        path = [0]
        key, lo, hi = self.key, self.lo, self.hi
        for k in seq:
            at, links, came = self.eq[path[-1]], self.eq, path[-1]
            while at >= 0 and key[at] != k:
                links, came = (lo, at) if k < key[at] else (hi, at)
                at = links[at]
            if at < 0:
                at = links[came] = self._new(k, path[-1])
            path.append(at)
        return path


def median_order(n: int):
    """0 to n - 1, the middle of every range before its halves."""
    ranges = deque([(0, n)])
    while ranges:
        lo, hi = ranges.popleft()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            ranges.append((lo, mid))
            ranges.append((mid + 1, hi))


def _keys(seq: list[int]) -> list[bytes]:
    """Digest of every prefix, the empty one first."""
    h = hashlib.sha256()
    out = [h.digest()]
    for k in seq:
        h.update(k.to_bytes(8, "little", signed=True))
        out.append(h.digest())
    return out


#: Nodes as shards leave them: final ones without a key, parts of boundary nodes
#: with one, and the ids that end there.
_NODE = [("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
         ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("gross", pa.int64()), ("once", pa.int64()), ("ends_sha256", pa.string()),
         ("shard", pa.int64()), ("ends", pa.string())]
_NODE_DDL = ("key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
             "n_children long, n_leaves long, gross long, once long, ends_sha256 string, shard long, ends string")
_NOTHING = hashlib.sha256(b"").hexdigest()


def _shard_nodes(shard: int, seqs: list[list[int]], sizes: list[list[int]], ends: list[list[int]],
                 before: int, after: int) -> pa.RecordBatch:
    """Nodes of one shard's distinct sequences, in ascending order.  ``ends`` has
    each sequence's conversations, ascending; ``before`` and ``after`` are the
    lengths shared with the neighbours' last and first sequence (-1: none)."""
    tree, end_of, size = TernaryTree(), {}, [0]
    for i in median_order(len(seqs)):
        path = tree.insert(seqs[i])
        size.extend(sizes[i][tree.depth[n] - 1] for n in range(len(size), len(tree.key)))
        end_of[path[-1]] = ends[i]
    first, last = tree.insert(seqs[0]), tree.insert(seqs[-1])
    opened, left = set(first[: before + 1]), set(last[: after + 1])
    key = dict(zip(first[: before + 1], _keys(seqs[0]))) | dict(zip(last[: after + 1], _keys(seqs[-1])))
    n = len(tree.key)
    convs, least = [0] * n, [None] * n
    leaves, gross, once, children, open_end = [0] * n, [0] * n, [0] * n, [0] * n, [True] * n
    for i in reversed(range(n)):
        here = end_of.get(i)
        if here:
            convs[i] += len(here)
            least[i] = here[0] if least[i] is None else min(least[i], here[0])
        if open_end[i] and i not in left:
            leaves[i] = 1
        gross[i] += convs[i] * size[i]
        mine = i not in opened
        once[i] += size[i] if mine else 0
        p = tree.parent[i]
        if p >= 0:
            convs[p] += convs[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
            leaves[p] += leaves[i]
            gross[p] += gross[i]
            once[p] += once[i]
            children[p] += mine
            open_end[p] = False
    parents = tree.parent
    text = {i: ",".join(map(str, e)) for i, e in end_of.items()}
    columns = [
        [key.get(i) for i in range(n)], [key.get(p) for p in parents], tree.depth, least,
        [None if p < 0 or p in key else least[p] for p in parents], convs, children, leaves, gross, once,
        [None if i in key else hashlib.sha256(text[i].encode()).hexdigest() if i in text else _NOTHING
         for i in range(n)],
        [shard] * n, [text.get(i) if i in key else None for i in range(n)]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _NODE)], [f for f, _ in _NODE])


def _build(batches):
    """Sorted rows (shard, ids, sizes, conv_id, before, after) -> nodes."""
    now, held, last = None, ([], [], []), None
    for b in batches:
        shards = b.column(0).to_numpy()
        convs = b.column(3).to_pylist()
        lists = [(np.asarray(b.column(c).values), np.asarray(b.column(c).offsets)) for c in (1, 2)]
        (ids, cut), (sizes, size_cut) = lists
        for r in range(b.num_rows):
            if shards[r] != (now and now[0]):
                if now:
                    yield _shard_nodes(now[0], *held, *now[1:])
                now = (int(shards[r]), b.column(4)[r].as_py(), b.column(5)[r].as_py())
                held, last = ([], [], []), None
            seq = ids[cut[r]: cut[r + 1]]
            raw = seq.tobytes()
            if raw != last:
                held[0].append(seq.tolist())
                held[1].append(sizes[size_cut[r]: size_cut[r + 1]].tolist())
                held[2].append([])
                last = raw
            held[2][-1].append(convs[r])
    if now:
        yield _shard_nodes(now[0], *held, *now[1:])


# --- all shards ------------------------------------------------------------
def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays; -1 if one is null."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True)
    return F.coalesce(F.when(differ == 0, F.size(a)).otherwise(differ - 1), F.lit(-1)).cast("long")


def _digests(batches):
    """Rows (key, shard, ends) sorted -> (key, ends_sha256), one digest at a time."""
    key, h, some = None, None, False
    for b in batches:
        found = []
        for k, e in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if k != key:
                if key is not None:
                    found.append((key, h.hexdigest()))
                key, h, some = k, hashlib.sha256(), False
            h.update((("," if some else "") + e).encode())
            some = True
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()),
                                          pa.array([d for _, d in found], pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])],
                                         ["key", "ends_sha256"])


def prefix_trie(seqs: DataFrame, scratch: Scratch, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All prefix nodes of (conv_id, ids, sizes): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    kept = scratch.save(seqs, "sequences")
    size = kept.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(1, -(-size // shard_turns))
    order = ["ids", "conv_id"]
    laid = scratch.save(
        kept.repartitionByRange(shards, *order).select(
            F.spark_partition_id().cast("long").alias("shard"), "ids", "sizes", "conv_id"), "shards")
    edges = laid.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    along = Window.orderBy("shard")  # one row per shard
    edges = edges.select("shard", _common(F.col("first"), F.lag("last").over(along)).alias("before"),
                         _common(F.col("last"), F.lead("first").over(along)).alias("after"))
    edges = scratch.save(edges, "edges")
    rows = laid.join(bounded_broadcast(edges, MAX_BROADCAST), "shard").select(
        "shard", "ids", "sizes", "conv_id", "before", "after")
    nodes = scratch.save(
        rows.repartition("shard").sortWithinPartitions("shard", *order).mapInArrow(_build, _NODE_DDL), "nodes")
    split = nodes.where("key IS NOT NULL")
    digests = (split.where("ends IS NOT NULL").select("key", "shard", "ends").repartition("key")
               .sortWithinPartitions("key", "shard").mapInArrow(_digests, "key binary, ends_sha256 string"))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "gross", "once")]
    merged = scratch.save(
        split.groupBy("key").agg(F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"),
                                 F.min("conv_id").alias("conv_id"), *sums)
        .join(digests, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING))), "merged")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    final = nodes.where("key IS NULL").drop("key", "shard", "ends").unionByName(
        merged.drop("key").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return final.join(bounded_broadcast(above, MAX_BROADCAST), "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", (F.col("gross") - F.col("once")).alias("saved_tokens"), "ends_sha256")
