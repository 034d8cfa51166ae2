"""N-gram Jaccard self-join by universe partition and pigeonhole.

A text's set is its distinct runs of five words (as 64-bit hashes).  Two sets
of similarity t or more differ in at most D = (1-t)/(1+t) * (|R|+|S|) elements.
Set sizes fall into bands of ratio 1/t; for a band the universe of shingles is
cut into m segments (by the hash's high bits) with

* all segments *exact* (a segment counts 1: it must be equal in both sets), or
* all segments with *one-deletion neighbourhoods* (a segment counts 2: it may
  differ in one element),

whichever costs less for that band's number of sets (:func:`allocate`).  As a
pair's D differences cannot spoil segments worth more than D, some segment
signature is shared.  Every set signs its own band, and the next one if a
partner can lie there.  Empty segments are left out; a set so unlucky that its
remaining segments are worth no more than D signs the empty ones as well.

Signatures that very many sets share (hot ones: common passages) are skipped by
every set whose other segments still outweigh D; a pair is lost only if both
sets would skip too much, so nothing is lost.  What remains meets per signature:

1. each set is verified against the partner it shares most signatures with
   (the smallest id per signature is the candidate), linked sets form clusters;
2. signatures that still join different clusters give all their cross-cluster
   pairs, which are verified exactly too.

Pairs inside one cluster need no check, as only components are wanted, so a
large group of near copies costs its size and not its square.  Texts that are
equal byte for byte are joined first, by digest.

Edge cases: a null or empty text, or white space alone, has an empty set and
links with nothing; repeated ``doc_id`` rows count as one document whose rows
are all kept; null ids come out with a null component.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm import graph
from stratus.llm.scratch import MAX_BROADCAST, Scratch, bounded_batches, bounded_broadcast
from stratus.llm.words import doc_words, mix, shingles

#: Similarity as a fraction: 100 * intersection >= 75 * union.
THRESHOLD = Fraction(3, 4)
#: Sets that may share a signature before it counts as hot.
HOT = 64
#: Extra segments over the pigeonhole's minimum, so that empty and hot
#: segments can be skipped.
SLACK = Fraction(15, 100)
_BANDS = 64  # a band's number fits the low bits of a signature


@dataclass(frozen=True)
class Band:
    """Sizes lo <= size < hi, and its universe partition."""

    lo: int
    hi: int
    segments: int
    deletions: bool

    def differences(self, size: int, t: Fraction) -> int:
        """Most elements by which a set of ``size`` and a partner differ."""
        partner = max(min(self.hi - 1, math.floor(size / t)), size if size >= self.lo else 0)
        return math.floor((1 - t) / (1 + t) * (size + partner))


def edges_of_bands(t: Fraction, largest: int) -> list[tuple[int, int]]:
    """Band limits with ratio 1/t: a partner lies in the same or the next band."""
    out, lo = [], 1
    while lo <= max(largest, 1):
        hi = max(lo + 1, math.floor(lo / t) + 1)
        out.append((lo, hi))
        lo = hi
    return out


def allocate(counts: dict[int, int], t: Fraction = THRESHOLD) -> list[Band]:
    """Bands over sizes 1..max with the cheaper of the two allocations each.

    ``counts`` maps a band's lower limit to its number of sets.  The cost of an
    allocation is the signatures it writes plus the false pairs expected from
    segments so small that unrelated sets often agree on them.
    """
    out = []
    for lo, hi in edges_of_bands(t, max(counts, default=1)):
        worst = math.floor((1 - t) / (1 + t) * 2 * (hi - 1))
        n = counts.get(lo, 0)
        options = []
        for deletions in (False, True):
            need = worst + 1
            m = need if not deletions else -(-need // 2)
            if m > 1:
                m += math.ceil(m * SLACK)
            per = lo / m  # expected elements of a segment, at least
            signs = m * (1 + per if deletions else 1)
            alone = m * per * math.exp(-per)  # segments of one element
            options.append((n * signs + n * n / 2 * alone * 1e-6, m, deletions))
        cost, m, deletions = min(options)
        out.append(Band(lo, hi, m, deletions))
    if len(out) > _BANDS:
        raise ValueError("sets are too large for the signature's band field")
    return out


def _segment_parts(u: np.ndarray, m: int):
    """(segment numbers, first index, size, sum) of the non-empty segments of a
    sorted set; the high bits choose the segment, so each is a run."""
    seg = ((u >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    first = np.concatenate(([0], np.flatnonzero(seg[1:] != seg[:-1]) + 1))
    size = np.diff(np.append(first, len(u)))
    total = np.add.reduceat(mix(u + np.uint64(0x2545F4914F6CDD1D)), first)
    return seg[first], first, size, total


def _sign(seg: np.ndarray, total: np.ndarray, band: int) -> np.ndarray:
    key = mix(total + mix(seg * np.uint64(_BANDS) + np.uint64(band + 1)))
    return (key & ~np.uint64(_BANDS - 1)) | np.uint64(band)


def signatures(u: np.ndarray, k: int, band: Band, t: Fraction):
    """(signatures, slack) of sorted set ``u`` in band ``k``.

    slack: the worth of the non-empty segments beyond the differences any
    partner of the band can have; below 0 the empty segments are signed too.
    """
    seg, first, size, total = _segment_parts(u, band.segments)
    sig = _sign(seg, total, k)
    worth = len(seg)
    if band.deletions:
        many = np.repeat(size > 1, size)
        less = (np.repeat(total, size) - mix(u + np.uint64(0x2545F4914F6CDD1D)))[many]
        of = np.repeat(seg, size)[many]
        sig = np.concatenate((sig, _sign(of, less, k)))
        worth += int((size > 1).sum())
    slack = worth - 1 - band.differences(len(u), t)
    if slack < 0:
        # Empty segments, and one-element segments less their element.
        rest = np.setdiff1d(np.arange(band.segments, dtype=np.uint64), seg)
        if band.deletions:
            rest = np.concatenate((rest, seg[size == 1]))
        sig = np.concatenate((sig, _sign(rest, np.zeros(len(rest), np.uint64), k)))
    return sig, slack


def _set_batches(batches):
    """Arrow batches (doc_id, text) -> (ids, list of sorted distinct shingle sets)."""
    for b in batches:
        yield b.column(0), [np.unique(shingles(w)) for w in doc_words(b.column(1))]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    """One list of 64-bit integers per array."""
    cuts = np.concatenate(([0], np.cumsum([len(x) for x in parts], dtype=np.int64)))
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.view(np.int64)))


def _parity(u: np.ndarray) -> np.ndarray:
    """Bits, each the parity of the elements that fall on it: two sets' bits
    differ in at most as many places as the sets differ in elements.  There are
    about as many bits as elements (a power of two, 64 at least); twice as many
    are folded to match by xor of their halves."""
    m = max(64, 1 << max(0, len(u) - 1).bit_length())
    odd = np.bincount((u & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sizes(batches):
    for ids, sets in _set_batches(batches):
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(u) for u in sets], pa.int64()),
             _lists([_parity(u) for u in sets])],
            ["doc_id", "n_shingles", "bits"])


def _signer(bands: list[Band], t: Fraction):
    lows = [b.lo for b in bands]

    def run(batches):
        for ids, sets in _set_batches(batches):
            doc, slack, sigs = [], [], []
            for i, u in zip(ids.to_pylist(), sets):
                n = len(u)
                if not n:
                    continue
                own = int(np.searchsorted(lows, n, "right")) - 1
                for k in (own, own + 1):
                    if k == len(bands) or k > own and math.floor(n / t) < bands[k].lo:
                        continue
                    s, left = signatures(u, k, bands[k], t)
                    doc.append(i)
                    slack.append(left)
                    sigs.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(slack, pa.int32()), _lists(sigs)],
                ["doc_id", "slack", "sigs"])

    return run


def _packed_sets(batches):
    for ids, sets in _set_batches(batches):
        yield pa.RecordBatch.from_arrays([ids, _lists(sets)], ["doc_id", "items"])


def _plausible(pairs: DataFrame, sizes: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (u, v) that sizes and parity bits don't rule out.  Both are
    bounds that no similar pair can break."""
    a = sizes.select(F.col("doc_id").alias("u"), F.col("n_shingles").alias("n_a"), F.col("bits").alias("a"))
    b = sizes.select(F.col("doc_id").alias("v"), F.col("n_shingles").alias("n_b"), F.col("bits").alias("b"))
    return pairs.join(a, "u").join(b, "v").where(_possible("n_a", "n_b", "a", "b", t)).select("u", "v")


def _possible(n_a: str, n_b: str, bits_a: str, bits_b: str, t: Fraction) -> Column:
    def folded(mine: str, other: str) -> Column:
        half = F.size(other)
        return F.when(F.size(mine) > half, F.zip_with(
            F.slice(mine, 1, half), F.slice(mine, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        ).otherwise(F.col(mine))
    apart = F.aggregate(
        F.zip_with(folded(bits_a, bits_b), folded(bits_b, bits_a), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda total, x: total + x)
    p, q = t.numerator, t.denominator
    return F.when(q * F.least(n_a, n_b) >= p * F.greatest(n_a, n_b),
                  (p + q) * apart <= (q - p) * (F.col(n_a) + F.col(n_b))).otherwise(False)


def _sets_of(pairs: DataFrame, known: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(doc_id, items): the whole sets of the documents in ``pairs``."""
    wanted = scratch.save(pairs.select(F.col("u").alias("doc_id")).union(
        pairs.select(F.col("v").alias("doc_id"))).distinct(), f"{name}-wanted")
    return scratch.save(
        known.join(bounded_broadcast(wanted, MAX_BROADCAST), "doc_id", "left_semi")
        .mapInArrow(_packed_sets, "doc_id long, items array<long>").dropDuplicates(["doc_id"]), name)


def _verified(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (u, v) whose sets have similarity t or more."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (pairs.join(a, "u").join(b, "v")
            .withColumn("both", both)
            .where(t.denominator * F.col("both")
                   >= t.numerator * (F.size("a") + F.size("b") - F.col("both")))
            .select("u", "v"))


def _clusters(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(doc_id, component) of the linked documents."""
    return scratch.save(graph.components(pairs, scratch, f"{name}-rounds"), name).select(
        F.col("node").alias("doc_id"), "component")


def _shared(rows: DataFrame, bands: list[Band], scratch: Scratch) -> DataFrame:
    """(sig, doc_id, head): signatures that several sets share, less the hot
    ones that a set can do without; head is the smallest sharing id."""
    per_sig = Window.partitionBy("sig")
    met = scratch.save(
        rows.withColumn("n", F.count("*").over(per_sig))
        .withColumn("head", F.min("doc_id").over(per_sig))
        .where("n > 1")
        .select("sig", "doc_id", "head", F.when(F.col("n") > HOT, F.col("slack")).alias("slack")),
        "met")
    hot = met.where("slack IS NOT NULL")
    band = F.col("sig").bitwiseAND(_BANDS - 1)
    worth = F.when(band.isin([k for k, b in enumerate(bands) if b.deletions]), 2).otherwise(1)
    bound = scratch.save(
        hot.groupBy("doc_id", band.alias("band")).agg(
            F.sum(worth).alias("lost"), F.min("slack").alias("slack"))
        .where("slack < lost").select("doc_id", "band"), "bound")
    held = hot.withColumn("band", band).join(bound, ["doc_id", "band"], "left_semi")
    again = (held.select("sig", "doc_id").withColumn("n", F.count("*").over(per_sig))
             .withColumn("head", F.min("doc_id").over(per_sig))
             .where("n > 1").select("sig", "doc_id", "head"))
    out = scratch.save(met.where("slack IS NULL").select("sig", "doc_id", "head").union(again), "shared")
    scratch.drop("met", "bound")
    return out


def _crossing(shared: DataFrame, clusters: DataFrame, sizes: DataFrame, tested: DataFrame,
              t: Fraction) -> DataFrame:
    """Pairs of different clusters that share a signature, are possible by size
    and parity bits, and were not tested yet."""
    of = shared.select("sig", "doc_id").join(clusters, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    per_sig = Window.partitionBy("sig")
    mixed = (of.withColumn("lo", F.min("component").over(per_sig))
             .withColumn("hi", F.max("component").over(per_sig)).where("lo < hi")
             .select("sig", "doc_id", "component")
             .join(sizes, "doc_id"))
    a, b = (mixed.select("sig", *[F.col(c).alias(f"{side}_{c}") for c in
                                  ("doc_id", "component", "n_shingles", "bits")]) for side in "ab")
    return (a.join(b, "sig")
            .where("a_doc_id < b_doc_id AND a_component <> b_component")
            .where(_possible("a_n_shingles", "b_n_shingles", "a_bits", "b_bits", t))
            .select(F.col("a_doc_id").alias("u"), F.col("b_doc_id").alias("v")).distinct()
            .join(tested, ["u", "v"], "left_anti"))


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id",
                    text_col: str = "text", t: Fraction = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    ``docs`` is read several times, so it should be a stored table.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = base.where("doc_id IS NOT NULL AND text IS NOT NULL")

    # Equal texts: the smallest id stands for all.  Only digests are shuffled.
    digest = known.select("doc_id", F.unhex(F.md5("text")).alias("digest"))
    first = scratch.save(digest.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    same = scratch.save(digest.join(first, "digest").where("doc_id <> first")
                        .select(F.col("doc_id").alias("v"), F.col("first").alias("u")).distinct(), "same")
    sizes = scratch.save(base.mapInArrow(_sizes, "doc_id long, n_shingles long, bits array<long>"), "sizes")

    # One count per band (a few dozen rows) picks each band's allocation.
    lows = [lo for lo, _ in edges_of_bands(t, sizes.agg(F.max("n_shingles")).first()[0] or 1)]
    low = F.lit(lows[0])
    for x in lows[1:]:
        low = F.when(F.col("n_shingles") >= x, F.lit(x)).otherwise(low)
    counts = {r["low"]: r["count"] for r in
              sizes.where("n_shingles > 0").groupBy(low.alias("low")).count().collect()}
    bands = allocate(counts, t)

    texts = known.join(bounded_broadcast(same.select(F.col("v").alias("doc_id")), MAX_BROADCAST),
                       "doc_id", "left_anti")
    rows = (texts.mapInArrow(_signer(bands, t), "doc_id long, slack int, sigs array<long>")
            .select("doc_id", "slack", F.explode("sigs").alias("sig")))
    shared = _shared(rows, bands, scratch)
    scratch.free()
    one = sizes.where("n_shingles > 0").dropDuplicates(["doc_id"])

    # Round 1: each set against the head it shares most signatures with.
    best = shared.where("doc_id <> head").groupBy("doc_id", "head").count().groupBy("doc_id").agg(
        F.max_by("head", F.struct("count", -F.col("head"))).alias("u"))
    tested = scratch.save(best.select("u", F.col("doc_id").alias("v")), "tested")
    maybe = scratch.save(_plausible(tested, one, t), "maybe")
    links = scratch.save(_verified(maybe, _sets_of(maybe, known, scratch, "sets"), t), "links")
    scratch.drop("sets")
    scratch.free()
    near = _clusters(links, scratch, "near")

    # Round 2: signatures that still join different clusters.
    rest = scratch.save(_crossing(shared, near, one, tested, t), "rest")
    more = scratch.save(_verified(rest, _sets_of(rest, known, scratch, "sets-2"), t), "more")
    scratch.drop("sets-2", "shared")
    scratch.free()
    nonempty = same.join(sizes.where("n_shingles > 0").select(F.col("doc_id").alias("v")).distinct(),
                         "v", "left_semi").select("u", "v")
    whole = _clusters(links.union(more).union(nonempty), scratch, "whole")
    return (sizes.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
