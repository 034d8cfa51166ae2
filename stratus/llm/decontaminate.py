"""Benchmark decontamination by latent semantic retrieval.

1. Words are hashed to ``FEATURES`` buckets; a bucket's frequency is counted over
   all documents (TF-IDF: a word weighs the log of passages per occurrence).
2. A randomised SVD gives the ``RANK`` leading right singular vectors of the
   passage-by-bucket matrix of all documents: the range finder and the Rayleigh-Ritz
   step are two distributed passes over their buckets, which are written once (two
   bytes a word).
3. Every window of two 16-word blocks of every document is folded into the
   latent space (divided by the singular values) and compared by cosine with
   every benchmark item, in blocks of items.
4. A candidate window must hold, in words of the item, ``SHARE`` of its weight (of
   the item's weight, if that is less); then it is confirmed on the words around it: the longest common subsequence
   must cover, by weight, ``STRONG`` of the item, or ``WEAK`` of it and ``ANSWER``
   of its last words (the part that holds an answer).

Edge cases: null, empty and blank texts match nothing; items without words are
skipped; repeated rows give repeated results' union (one row per id and item);
null ids are not reported; an empty table on either side gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch, bounded_batches
from stratus.llm.words import doc_words

FEATURES, RANK, EXTRA = 1 << 15, 96, 16
BLOCK = 16
PASSAGE = 2 * BLOCK
#: Least cosine of a candidate, and least share of its or the item's weight in the item's words.
COSINE, SHARE = 0.45, 0.25
STRONG, WEAK, ANSWER, ANSWER_WORDS = 0.75, 0.6, 0.75, 8
#: Items compared in one pass over the documents (32 kB each in a task).
ITEMS_PER_PASS = 1_000
#: Words folded at once in the search and in the fit, vectors gathered at once, and words
#: in a stored row.
CHUNK, FIT, GATHER, ROW = 1 << 14, 1 << 17, 1 << 11, 1 << 11
#: Pieces of the fit that are added up in single precision.
PIECES = 64
_SHIFT = np.uint64(64 - 15)


def buckets(words: np.ndarray) -> np.ndarray:
    return (words >> _SHIFT).astype(np.int32)


#: Bucket that fills up a text's last passage; it weighs nothing.
_PAD = FEATURES


def _padded(col) -> np.ndarray:
    """Buckets of the texts, one after another, each filled up to whole passages."""
    found = []
    for words in doc_words(col):
        if len(words):
            found += [buckets(words).astype(np.uint16), np.full(-len(words) % PASSAGE, _PAD, np.uint16)]
    return np.concatenate(found) if found else np.empty(0, np.uint16)


def _bucket_rows(batches):
    """Texts -> rows of up to :data:`ROW` words' buckets (whole passages), two bytes each."""
    for b in batches:
        found = _padded(b.column(0))
        rows = [found[i: i + ROW].tobytes() for i in range(0, len(found), ROW)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["buckets"])


def _pieces(batches):
    """The buckets of whole passages, at most :data:`FIT` at a time."""
    for b in batches:
        col = b.column(0)
        _, offsets, data = col.buffers()
        off = np.frombuffer(offsets, np.int32)[col.offset: col.offset + len(col) + 1]
        found = np.frombuffer(data, np.uint16, (off[-1] - off[0]) // 2, off[0]) if len(col) else np.empty(0, np.uint16)
        for i in range(0, len(found), FIT):
            yield found[i: i + FIT]


def _frequencies(batches):
    """Occurrences of each bucket, and passages (as bucket -1), summed over the task."""
    seen, total = np.zeros(FEATURES + 1, np.int64), 0
    for piece in _pieces(batches):
        seen += np.bincount(piece, minlength=FEATURES + 1)
        total += len(piece) // PASSAGE
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, FEATURES), pa.int32()), pa.array(np.append([total], seen[:_PAD]), pa.int64())],
        ["bucket", "n"])


def idf(pieces: DataFrame) -> np.ndarray:
    """Weight of each bucket, from all texts (a fixed number of counts is collected)."""
    rows = (pieces.mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket")
            .agg(F.sum("n").alias("n")).collect())
    n = np.zeros(FEATURES + 1)
    for r in rows:
        n[r["bucket"] + 1] = r["n"]
    return np.log1p((1 + n[0]) / (1 + n[1:])).astype(np.float32)


def _sums(table: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """Sums of the table's rows ``index``, ``size`` at a time (the last may be of fewer)."""
    if size == 1:
        return np.take(table, index, axis=0, mode="clip")
    whole = len(index) // size * size
    out = np.empty((-(-len(index) // size), table.shape[1]), table.dtype)
    ones = np.ones((1, size), table.dtype)
    step = max(GATHER // size, 1) * size
    for i in range(0, whole, step):
        part = np.take(table, index[i: min(i + step, whole)], axis=0, mode="clip")
        found = np.matmul(ones, part.reshape(-1, size, table.shape[1]))
        out[i // size: i // size + len(found)] = found[:, 0]
    if whole < len(index):
        out[-1] = table[index[whole:]].sum(0)
    return out


def _run_sums(table: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the table's rows ``index`` in runs that start at ``first``, runs of one
    length together."""
    length = np.diff(first, append=len(index))
    order = np.argsort(length, kind="stable")
    size = length[order]
    out = np.empty((len(first), table.shape[1]), table.dtype)
    cuts = np.append(np.flatnonzero(np.diff(size, prepend=-1)), len(size))
    for a, b in zip(cuts[:-1], cuts[1:]):
        rows = (first[order[a:b], None] + np.arange(size[a])).ravel()
        out[order[a:b]] = _sums(table, index[rows], int(size[a]))
    return out


def _filled(x: np.ndarray) -> np.ndarray:
    """``x`` by bucket, with zeros for the filling bucket."""
    return np.concatenate((x, np.zeros((1, *x.shape[1:]), x.dtype)))


def _range_pass(weight: np.ndarray, seed: int, size: int, parts: int):
    """Task sums of A^T (A start), in ``parts`` slices of rows; the rows of A are the
    passages' tf-idf vectors of norm 1, ``start`` is random, made from ``seed``."""
    def run(batches):
        start = np.random.default_rng(seed).normal(size=(FEATURES, size)).astype(np.float32)
        table, square = _filled(start * weight[:, None]), _filled(weight * weight)
        out, some = np.zeros(table.shape, np.float64), np.zeros(table.shape, np.float32)
        for k, piece in enumerate(_pieces(batches), 1):
            norm2 = square[piece].reshape(-1, PASSAGE).sum(1)
            y = _sums(table, piece, PASSAGE) / norm2[:, None]
            order = np.argsort(piece, kind="stable")
            hit = piece[order]
            first = np.flatnonzero(np.diff(hit.astype(np.int32), prepend=-1))
            some[hit[first]] += _run_sums(y, order // PASSAGE, first)
            if k % PIECES == 0:
                out += some
                some[:] = 0
        out += some
        step = FEATURES // parts
        slices = [slice(k * step, (k + 1) * step) for k in range(parts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(parts), pa.int32()),
             pa.array([(out[x] * weight[x, None]).astype(np.float32).tobytes() for x in slices], pa.binary())],
            ["part", "rows"])
    return run


def _inner_pass(weight: np.ndarray, q: np.ndarray):
    """Task sums of (A q)^T (A q)."""
    def run(batches):
        table, square = _filled(q * weight[:, None]), _filled(weight * weight)
        out = np.zeros((q.shape[1], q.shape[1]), np.float64)
        for piece in _pieces(batches):
            z = _sums(table, piece, PASSAGE)
            z /= np.sqrt(square[piece].reshape(-1, PASSAGE).sum(1))[:, None]
            out += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int32()), pa.array([out.astype(np.float32).tobytes()], pa.binary())], ["part", "rows"])
    return run


def _sum_rows(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in group["rows"])
    return pd.DataFrame({"part": group["part"].iloc[:1], "rows": [total.astype(np.float32).tobytes()]})


def _summed(pieces: DataFrame, run, shape: tuple[int, int]) -> np.ndarray:
    got = (pieces.mapInArrow(run, "part int, rows binary")
           .groupBy("part").applyInPandas(_sum_rows, "part int, rows binary").collect())
    out = {r["part"]: np.frombuffer(r["rows"], np.float32).reshape(-1, shape[1]) for r in got}
    return np.concatenate([out[k] for k in sorted(out)]) if out else np.zeros(shape, np.float32)


def latent_basis(pieces: DataFrame, weight: np.ndarray, rank: int = RANK, seed: int = 11,
                 parts: int = 16) -> np.ndarray:
    """Bucket vectors: right singular vectors over singular values (FEATURES x rank),
    of the passages of all texts.

    The range finder and the Rayleigh-Ritz step are a pass each; the latter needs the
    inner products of the projected passages only.  A task of the former returns its
    sums of 15 MB, so it has as many tasks as there are cores."""
    size = rank + EXTRA
    few = pieces.coalesce(pieces.sparkSession.sparkContext.defaultParallelism)
    q, _ = np.linalg.qr(_summed(few, _range_pass(weight, seed, size, parts), (FEATURES, size)))
    value, turn = np.linalg.eigh(_summed(pieces, _inner_pass(weight, q), (size, size)).astype(np.float64))
    lead = np.argsort(value)[::-1][:rank]
    scale = np.sqrt(np.maximum(value[lead], 1e-12 + value.max() * 1e-9))
    return q @ (turn[:, lead] / scale).astype(np.float32) * weight[:, None]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def windows(words: np.ndarray, basis: np.ndarray):
    """Unit latent vectors of all windows of two blocks, one block apart, in
    pieces: (first word of the piece, vectors)."""
    at = 0
    while True:
        piece = words[at: at + CHUNK + BLOCK]
        sums = _sums(basis, buckets(piece), BLOCK)
        yield at, _unit(sums[:-1] + sums[1:] if len(sums) > 1 else sums)
        at += CHUNK
        if at + BLOCK >= len(words):
            return


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit per element of ``a``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for x in b:
        hit = where.get(x)
        if hit:
            keep = row & hit
            row = (row + keep | row - keep) & full
    return len(a) - row.bit_count()


def weighted_lcs(a: np.ndarray, weight: np.ndarray, b: np.ndarray) -> float:
    """Largest weight of a common subsequence, as a share of all of ``a``."""
    best = np.zeros(len(b) + 1)
    for x, w in zip(a, weight):
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + (b == x) * w))
    return float(best[-1] / max(weight.sum(), 1e-12))


def _searcher(items: list[tuple[int, np.ndarray]], basis: np.ndarray, weight: np.ndarray, cosine: float):
    # Items' vectors as rows; their words for the confirmation.
    vectors = np.stack([_unit(basis[buckets(w)].sum(0)) for _, w in items])
    total = np.array([weight[buckets(w)].sum() for _, w in items])
    span = np.arange(2 * BLOCK)

    def confirmed(item: np.ndarray, around: np.ndarray):
        """(weighted share of the item, of its end) found in order, if enough.

        A plain subsequence is tried first; by weight, so that frequent words,
        which any text holds in some order, count for little."""
        if lcs(item.tolist(), around.tolist()) < WEAK * len(item):
            return None
        w = weight[buckets(item)]
        share = weighted_lcs(item, w, around)
        answer = weighted_lcs(item[-ANSWER_WORDS:], w[-ANSWER_WORDS:], around)
        return (share, answer) if share >= STRONG or share >= WEAK and answer >= ANSWER else None

    def run(batches):
        holds = np.zeros((len(items), FEATURES), bool)
        for k, (_, w) in enumerate(items):
            holds[k, buckets(w)] = True
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for doc, words in zip(ids, doc_words(batch.column(1))):
                if not len(words):
                    continue
                best: dict[int, tuple] = {}
                bucket = buckets(words)
                heavy = weight[bucket]
                for at, z in windows(words, basis):
                    w, k = np.nonzero(z @ vectors.T >= cosine)
                    place = at + w[:, None] * BLOCK + span
                    inside = place < len(words)
                    place = np.minimum(place, len(words) - 1)
                    mass = heavy[place] * inside
                    shared = (mass * holds[k[:, None], bucket[place]]).sum(1)
                    enough = shared >= SHARE * np.minimum(mass.sum(1), total[k])
                    w, k = w[enough], k[enough]
                    # Neighbouring windows of one item are confirmed together.
                    order = np.lexsort((w, k))
                    w, k = w[order], k[order]
                    cut = np.flatnonzero((np.diff(k) != 0) | (np.diff(w) > 4)) + 1
                    for g in np.split(np.arange(len(k)), cut) if len(k) else []:
                        item = items[k[g[0]]][1]
                        lo = max(0, at + int(w[g[0]]) * BLOCK - len(item))
                        hi = at + int(w[g[-1]]) * BLOCK + 2 * BLOCK + len(item)
                        found = confirmed(item, words[lo:hi])
                        if found:
                            best[int(k[g[0]])] = max(best.get(int(k[g[0]]), ()), (*found, lo))
                out += [(doc, items[k][0], *v) for k, v in best.items()]
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))],
                ["doc_id", "item_id", "item_share", "answer_share", "near_word"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id, item_share, answer_share, near_word): documents that hold
    a benchmark item, one row per pair."""
    schema = "doc_id long, item_id long, item_share double, answer_share double, near_word long"
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    n_items, n_docs = benchmark.count(), rows.count()
    if not n_items or not n_docs:
        return spark.createDataFrame([], schema)
    pieces = scratch.save(rows.select("text").mapInArrow(_bucket_rows, "buckets binary"), "buckets")
    weight = idf(pieces)
    basis = latent_basis(pieces, weight)
    scratch.drop("buckets")

    parts = -(-n_items // ITEMS_PER_PASS)
    out = None
    for part in range(parts):
        block = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()
                                & (F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part))
        got = block.select(F.col("item_id").cast("long"), "text").sort("item_id", "text").toArrow()
        items = [(i, w) for i, w in zip(got.column(0).to_pylist(), _all_words(got.column(1))) if len(w)]
        if items:
            found = rows.mapInArrow(_searcher(items, basis, weight, cosine), schema)
            out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], schema)
    best = F.max_by(F.struct("answer_share", "near_word"), F.struct("item_share", "answer_share", "near_word"))
    return out.groupBy("doc_id", "item_id").agg(F.max("item_share").alias("item_share"), best.alias("b")).select(
        "doc_id", "item_id", "item_share", "b.answer_share", "b.near_word")


def _all_words(col) -> list[np.ndarray]:
    return [w for c in (col.chunks if isinstance(col, pa.ChunkedArray) else [col]) for w in doc_words(c)]
