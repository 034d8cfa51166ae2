"""Importance resampling towards a target distribution, on hashed word n-grams.

A text's words are runs of digits, letters and non-ASCII bytes, A-Z lower-cased;
its features are all runs of 1 to ``max_n`` consecutive words joined by one
space, repeats counted.  A feature's bucket is its CRC-32 modulo ``buckets``.

The CRC of every n-gram comes from prefix CRCs.  A run of texts is normalised
once (one space between words) and scanned once, storing the running CRC at
every byte.  CRC is linear over GF(2): if R(p) is the register after p bytes,
started at zero, the register over bytes a to b alone is R(b) xor R(a) shifted by
b - a zero bytes, so any n-gram costs two stored values and one table shift,
whatever its length, and no n-gram is ever built as a string.

From the buckets' counts in the corpus and the target each bucket gets a gain
(the log ratio of its smoothed shares, in thousandths); a document's weight is
the floored mean of its features' gains.  Adding Gumbel noise from a hash of the
document's id and taking the highest scores draws without replacement with
probabilities in proportion to exp(weight / 1000).

Edge cases: null, empty and word-less texts have no features and weight 0; they
are scored but have too few words to be drawn.  An empty target leaves only the
corpus's shares; an empty corpus gives no rows.  A null id is hashed as the empty
string.  Rows that repeat an id draw the same noise and are ranked on their own
(ties: smaller id, nulls first, then larger weight, then fewer features); equal
rows take consecutive ranks.  Other columns are ignored unless asked for by
``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch
from stratus.llm.words import text_buffers

BUCKETS, MAX_N, SEED = 10_000, 2, 7
#: Documents of fewer words are not drawn, and this share of the others is.
MIN_WORDS, PERCENT = 20, 25
#: Bytes scanned at once (a longer text goes in pieces, a single longer word whole).
PIECE = 1 << 20

_POLY = np.uint32(0xEDB88320)
_FULL = np.uint32(0xFFFFFFFF)
_BLOCK = 256


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ _POLY, t >> 1)
    return t


_STEP = _byte_table()
_shifts: list[np.ndarray] = []


def _apply(table: np.ndarray, which: np.ndarray | int, x: np.ndarray) -> np.ndarray:
    """Linear maps ``table[which]`` (4 byte tables each) of registers ``x``."""
    flat, at = table.reshape(-1), np.asarray(which, np.int64) * 1024
    out = flat[at + (x & 255)]
    for j in (1, 2, 3):
        out = out ^ flat[at + (256 * j) + ((x >> np.uint32(8 * j)) & 255)]
    return out


def _shift_table(digit: int) -> np.ndarray:
    """Maps that append d * 256**digit zero bytes, for d below 256."""
    while len(_shifts) <= digit:
        basis = np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
        out = np.empty((256, 4, 256), np.uint32)
        out[0] = basis
        if _shifts:  # 256 times the largest step of the digit below, plus one more
            low = _shifts[-1]
            one = _apply(low, 1, _apply(low, 255, basis))
        else:
            one = _STEP[basis & 255] ^ (basis >> np.uint32(8))
        out[1] = one
        for d in range(2, 256):
            out[d] = _apply(out, 1, out[d - 1])
        _shifts.append(out)
    return _shifts[digit]


def shift(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers ``x`` after ``n`` further zero bytes each."""
    digit, n = 0, np.asarray(n, np.int64)
    while digit == 0 or (n >> (8 * digit)).any():
        x = _apply(_shift_table(digit), (n >> (8 * digit)) & 255, x)
        digit += 1
    return x


class RunningCrc:
    """Running registers of a byte buffer, and the CRC-32 of any part of it."""

    def __init__(self, data: np.ndarray):
        n = -(-max(1, len(data)) // _BLOCK)
        padded = np.zeros(n * _BLOCK, np.uint8)
        padded[: len(data)] = data
        columns = np.ascontiguousarray(padded.reshape(n, _BLOCK).T)
        # All blocks are scanned side by side, each from zero ...
        self.inside = np.zeros((_BLOCK + 1, n), np.uint32)
        state = self.inside[0]
        for i in range(_BLOCK):
            state = _STEP[(state ^ columns[i]) & 255] ^ (state >> np.uint32(8))
            self.inside[i + 1] = state
        # ... and joined: block k starts with what all blocks before it leave.
        start = np.concatenate((self.inside[0][:1], self.inside[_BLOCK][:-1]))
        step = 1
        while step < n:
            moved = shift(start[:-step], np.full(n - step, step * _BLOCK))
            start = np.concatenate((start[:step], start[step:] ^ moved))
            step *= 2
        self.start = start

    def register(self, at: np.ndarray) -> np.ndarray:
        block = np.minimum(at // _BLOCK, len(self.start) - 1)
        inner = at - block * _BLOCK
        return self.inside[inner, block] ^ shift(self.start[block], inner)

    def crc32(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes from each ``lo`` to its ``hi``."""
        return self.cancel(self.register(lo), self.register(hi), hi - lo)

    @staticmethod
    def cancel(before: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
        return shift(before ^ _FULL, length) ^ after ^ _FULL


_NORMAL = np.zeros(256, np.uint8)  # 0: separator
_NORMAL[48:58] = np.arange(48, 58)
_NORMAL[65:91] = np.arange(97, 123)
_NORMAL[97:123] = np.arange(97, 123)
_NORMAL[128:] = np.arange(128, 256)


def _piece(data: np.ndarray, bounds: np.ndarray, max_n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of texts laid end to end, each ended by a separator at ``bounds``:
    (crc, first word's index, words in it, words of each text)."""
    plain = _NORMAL[data]
    word = plain != 0
    before = np.concatenate(([False], word[:-1]))
    first = np.flatnonzero(word & ~before)
    per_text = np.diff(np.searchsorted(first, bounds), prepend=0)
    keep = word | before
    text = np.where(word, plain, np.uint8(0x20))[keep]
    gap = np.flatnonzero(text == 0x20)  # one after every word: data ends with a separator
    lo = np.concatenate(([0], gap[:-1] + 1)) if len(gap) else gap
    if not len(gap):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint32), none, none, per_text
    run = RunningCrc(text)
    at_lo, at_hi = run.register(lo), run.register(gap)
    owner = np.repeat(np.arange(len(per_text)), per_text)
    crcs, firsts, sizes = [], [], []
    for k in range(1, max_n + 1):
        i = np.arange(max(0, len(gap) - k + 1))
        i = i[owner[i] == owner[i + k - 1]]
        crcs.append(run.cancel(at_lo[i], at_hi[i + k - 1], gap[i + k - 1] - lo[i]))
        firsts.append(i)
        sizes.append(np.full(len(i), k))
    return np.concatenate(crcs), np.concatenate(firsts), np.concatenate(sizes), per_text


_GAP = np.full(1, 0x20, np.uint8)


def _long(data: np.ndarray, max_n: int) -> Iterator[tuple[np.ndarray, int]]:
    """(crcs, words) of a long text, piece by piece.  A piece goes back over the
    last ``max_n`` - 1 words of the one before; features inside those are skipped."""
    at, back = 0, 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and _NORMAL[data[end]]:
            stop = min(end + PIECE, len(data))
            gaps = np.flatnonzero(_NORMAL[data[end:stop]] == 0)
            end = end + int(gaps[0]) if len(gaps) else stop
        part = np.concatenate((data[at:end], _GAP))
        crc, first, size, words = _piece(part, np.array([len(part)]), max_n)
        yield crc[first + size > back], int(words[0]) - back
        if end == len(data):
            return
        starts = np.flatnonzero((_NORMAL[part[1:]] != 0) & (_NORMAL[part[:-1]] == 0)) + 1
        if _NORMAL[part[0]]:
            starts = np.concatenate(([0], starts))
        back = min(max_n - 1, len(starts))
        at = at + int(starts[-back]) if back and int(starts[-back]) > 0 else end
        if at == end:
            back = 0


def features(column: pa.Array, max_n: int = MAX_N) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of consecutive rows: (crc of every feature, its row within the
    run, words of each row).  A long row may come in several runs of one row,
    all but the last marked by a words entry of -1 - words."""
    held: list[np.ndarray] = []
    size = 0

    def flush():
        bounds = np.cumsum([len(b) + 1 for b in held])
        crc, first, _, words = _piece(np.concatenate([x for b in held for x in (b, _GAP)]), bounds, max_n)
        return crc, np.repeat(np.arange(len(words)), words)[first], words

    for b in text_buffers(column):
        if held and size + len(b) > PIECE:
            yield flush()
            held, size = [], 0
        if len(b) <= PIECE:
            held.append(b)
            size += len(b) + 1
            continue
        parts = list(_sums(_long(b, max_n)))
        for crc, words, last in parts:
            yield crc, np.zeros(len(crc), np.int64), np.array([words if last else -1 - words])
    if held:
        yield flush()


def _sums(parts):
    """(crcs, words, whether last) of pieces, one held back."""
    held = None
    for p in parts:
        if held is not None:
            yield (*held, False)
        held = p
    if held is not None:
        yield (*held, True)


def _counter(buckets: int, max_n: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for crc, _, _ in features(batch.column(0), max_n):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """(bucket, n): features of all texts by bucket; tasks count before the shuffle."""
    parts = texts.select(F.col("text").cast("string")).mapInArrow(_counter(buckets, max_n), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """(bucket, gain): floor(1000 ln of the ratio of the smoothed shares), for all
    ``buckets`` buckets."""
    spark = docs.sparkSession
    both = (spark.range(buckets).select(F.col("id").alias("bucket"))
            .join(bucket_counts(docs, buckets, max_n).withColumnRenamed("n", "s"), "bucket", "left")
            .join(bucket_counts(target, buckets, max_n).withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"),
                    F.coalesce("t", F.lit(0)).cast("double").alias("t")))
    everything = Window.partitionBy(F.lit(0))  # one row per bucket
    s_all, t_all = F.sum("s").over(everything), F.sum("t").over(everything)
    ratio = ((F.col("t") + 1) * (s_all + buckets)) / ((F.col("s") + 1) * (t_all + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def _weigher(gain: np.ndarray, max_n: int, n_carry: int, fields: list[str]):
    buckets = np.uint32(len(gain))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            words, found, total = (np.zeros(n, np.int64) for _ in range(3))
            at = 0
            for crc, row, count in features(batch.column(0), max_n):
                value = gain[crc % buckets]
                part = slice(at, at + len(count))
                found[part] += np.bincount(row, minlength=len(count))
                sums = np.zeros(len(count), np.int64)
                np.add.at(sums, row, value)
                total[part] += sums
                words[part] += np.where(count < 0, -1 - count, count)
                at += len(count) if len(count) != 1 or count[0] >= 0 else 0
            weight = np.floor_divide(total, np.maximum(found, 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(1 + i) for i in range(n_carry)),
                 *(pa.array(x) for x in (words, found, weight))], fields)

    return run


def scores(docs: DataFrame, target: DataFrame, scratch: Scratch, buckets: int = BUCKETS, max_n: int = MAX_N,
           seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carried columns, n_words, n_features, weight, score) of every
    document, written and reread.

    The corpus is read twice: once for the bucket counts, of which ``buckets``
    numbers (a fixed size) go through the driver into the tasks of the second.
    """
    gain = np.zeros(buckets, np.int64)
    for row in gains(docs, target, buckets, max_n).collect():
        gain[row["bucket"]] = row["gain"]
    base = docs.select(F.col("text").cast("string").alias("_text"), F.col("doc_id").cast("long").alias("doc_id"),
                       *(F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)))
    kinds = [base.schema[f"_carry{i}"].dataType.simpleString() for i in range(len(carry))]
    fields = ["doc_id", *(f"_carry{i}" for i in range(len(carry))), "n_words", "n_features", "weight"]
    ddl = ", ".join(f"{f} {k}" for f, k in zip(fields, ["long", *kinds, "long", "long", "long"]))
    weighed = base.mapInArrow(_weigher(gain, max_n, 1 + len(carry), fields), ddl)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    out = weighed.withColumn("score", F.col("weight") + noise)
    return scratch.save(out.withColumnsRenamed({f"_carry{i}": c for i, c in enumerate(carry)}), "scores")


def ranked(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the floor(``percent`` / 100 x N)
    highest scores of the N documents with ``min_words`` words; null for others.

    Scores are thousandths of logarithms, so there are less than 200,000 distinct
    ones whatever the corpus: the number of documents above each is a running sum
    over that table, and only documents of one score are sorted among themselves.
    The noise keeps any one score below 0.04 % of the documents.
    """
    able = F.col("n_words") >= min_words
    per_score = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("_here"))
    everything = Window.partitionBy(F.lit(0))
    down = everything.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = per_score.select(
        "score", F.coalesce(F.sum("_here").over(down), F.lit(0)).alias("_above"),
        F.floor(F.sum("_here").over(everything) * percent / 100).alias("_most")).where("_above < _most")
    placed = scored.join(F.broadcast(above), "score", "left")
    hit = able & F.col("_above").isNotNull()
    ties = Window.partitionBy("score").orderBy("doc_id", F.desc("weight"), "n_features")
    place = F.col("_above") + F.row_number().over(ties)
    drawn = placed.where(hit).withColumn("_place", place).withColumn(
        "rank", F.when(F.col("_place") <= F.col("_most"), F.col("_place"))).drop("_place")
    rest = placed.where(~hit).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("_above", "_most")


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS,
             percent: int = PERCENT, **options) -> DataFrame:
    """The drawn documents themselves: all columns of ``docs``."""
    names = tuple(c for c in docs.columns if c != "doc_id")
    clash = {c: f"_column{i}" for i, c in enumerate(names)}
    kept = docs.select("doc_id", F.col("text"), *(F.col(c).alias(to) for c, to in clash.items()))
    found = ranked(scores(kept, target, scratch, carry=tuple(clash.values()), **options), min_words, percent)
    return (found.where("rank IS NOT NULL").select("doc_id", *clash.values())
            .withColumnsRenamed({to: c for c, to in clash.items()}).select(docs.columns))
