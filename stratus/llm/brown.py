"""Class-based n-gram scoring (Brown classes by the exchange algorithm).

log10 P(text) = sum over tokens of log10 P(class | previous class) +
log10 P(word | class); a text's last token is one end mark, which is also the
context of its first word.

* Counts of every word come from all training texts, as do the contexts.
* The clustered vocabulary is every word that occurs :data:`MIN_COUNT` times; if more
  than 1 / :data:`SHARE` words do, the least count rises until so many are left, so
  that it can be sent to the tasks.  Exchange puts them into ``CLASSES`` classes.  It
  starts with the ``SEED_WORDS`` most frequent words: each round sums, as a Spark job
  over their bigrams, how often every word stands before and after every class, then
  moves each word to the class under which those contexts are likeliest (half of the
  words per round, so that moves don't swap back and forth; fewer after a round that
  had to be undone).  A sweep then places every other word of the vocabulary likewise,
  and rounds of the same kind follow over the whole vocabulary, seeds and others.
* For these the neighbours of every word that is no seed are shuffled to one place and
  written once; a round reads them twice (to move words and to count transitions).
* A round or sweep that would lower the likelihood of the training texts under the
  class model is undone, so the likelihood never falls.
* Rarer and unseen words belong to a class by their last two bytes; inside it a
  word has its smoothed relative frequency.
* Class transitions are interpolated with the class's own frequency.

Scoring reads whole texts.  Counts of rarer words are joined, so every word's count
is exact.

Edge cases: null and empty texts are the end mark alone; a null id is a training
row; rows that repeat an id are scored each; without training texts all counts
are 0 and every token is as likely as the end mark's class allows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch, bounded_batches
from stratus.llm.words import PIECE, hash_words, text_buffers

SEED_WORDS, CLASSES, TAIL_CLASSES = 4096, 64, 64
#: Least count of a clustered word, and one by the most of them that there may be.
MIN_COUNT, SHARE = 2, 2e-7
ROUNDS = 6
#: Weight of the class's own frequency in a transition.
BACKOFF = 20.0
_ALL = CLASSES + TAIL_CLASSES + 1  # exchange classes, tail classes, end
# Units: the seeds, other words by their tail class (those outside the vocabulary, then
# those inside), the end mark.
_END = SEED_WORDS + 2 * TAIL_CLASSES
_UNITS = _END + 1
_END_CLASS = _ALL - 1
#: Tokens whose contexts a task adds up before it sends them on.
_FLUSH = 1 << 21
#: Neighbours in a stored row, at least; words whose contexts are summed at once.
_ROW, _WORDS = 1 << 10, 1 << 12
_SLICES = 16


def _tail_class(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class (0 to TAIL_CLASSES - 1) of each word by its last two bytes, A-Z lower-cased."""
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint32)
    last = low[ends - 1]
    before = np.where(ends > 1, low[np.maximum(ends - 2, 0)], 32)
    before[before <= 32] = 32  # a word of one byte
    return ((last * 0x9E3779B1 + before * 0x85EBCA77).astype(np.uint32) >> np.uint32(26)).astype(np.int64)


_GAP = np.full(1, 0x20, np.uint8)


def _token_groups(col):
    """For runs of consecutive rows: (word hashes, tail classes, words of each row)."""
    held, size = [], 0

    def flush():
        raw = np.concatenate([x for r in held for x in (r, _GAP)])
        h, starts, ends = hash_words(raw)
        bounds = np.cumsum([len(r) + 1 for r in held])
        counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
        return h, (_tail_class(raw, ends) if len(h) else np.empty(0, np.int64)), counts

    for raw in text_buffers(col):
        if held and size + len(raw) > PIECE:
            yield flush()
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield flush()


def _laid_out(values: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, places of the words): the rows' values with ``end`` before, between
    and after them, so that neighbours in it are the bigrams of all rows."""
    place = np.arange(1, len(values) + 1) + np.repeat(np.arange(len(counts)), counts)
    out = np.full(len(values) + len(counts) + 1, end, np.int64)
    out[place] = values
    return out, place


def _count_words(batches):
    """(word, tail class, n) per task batch, and the number of texts as word 0."""
    for b in batches:
        parts = list(_token_groups(b.column(0)))
        h = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
        tail = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
        word, first, n = np.unique(h, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(word.view(np.int64), 0)), pa.array(np.append(tail[first], -1), pa.int64()),
             pa.array(np.append(n, b.num_rows), pa.int64())], ["word", "tail", "n"])


class Lexicon:
    """Sorted hashes of the clustered words, with counts and ranks by frequency; the
    first SEED_WORDS ranks are units of their own in the first clustering."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        rank = np.arange(len(words), dtype=np.int32)
        self.words, self.counts = words[order], counts[order]
        self.rank = rank[order]
        # Words by their leading bits: about two buckets a word.
        bits = max(1, len(words).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(
            (self.words >> self.shift).astype(np.int64), minlength=1 << bits)))).astype(np.int32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "counts"}  # no task reads them

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, whether known)."""
        known = np.zeros(len(h), bool)
        bucket = (h >> self.shift).astype(np.int64)
        at = self.starts[bucket].astype(np.int64)
        live = np.flatnonzero(at < self.starts[bucket + 1])
        a, end, x = at[live], self.starts[bucket[live] + 1], h[live]
        while len(live):
            hit = self.words[a] == x
            known[live[hit]] = True
            at[live[hit]] = a[hit]
            on = ~hit & (a + 1 < end)
            live, a, end, x = live[on], a[on] + 1, end[on], x[on]
        return np.minimum(at, max(0, len(self.words) - 1)), known

    def units(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Unit of each word: its rank if it is a seed, else its tail class's."""
        at, known = self.find(h)
        if not len(self.words):
            return SEED_WORDS + tail
        rank = self.rank[at]
        return np.where(known, np.where(rank < SEED_WORDS, rank, SEED_WORDS + TAIL_CLASSES + tail), SEED_WORDS + tail)


def _bigrams(lexicon: Lexicon):
    def run(batches):
        for b in batches:
            pairs = []
            for h, tail, counts in _token_groups(b.column(0)):
                s, _ = _laid_out(lexicon.units(h, tail), counts, _END)
                pairs.append(s[:-1] * _UNITS + s[1:])
            pair, n = np.unique(np.concatenate(pairs or [np.empty(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])
    return run


def _contexts(classes: np.ndarray):
    """Task sums: how often each unit stands after (before) each class."""
    def run(batches):
        after = np.zeros(_UNITS * _ALL)
        before = np.zeros(_UNITS * _ALL)
        for b in batches:
            pair, n = (b.column(i).to_numpy() for i in range(2))
            left, right = pair // _UNITS, pair % _UNITS
            after += np.bincount(right * _ALL + classes[left], n, len(after))
            before += np.bincount(left * _ALL + classes[right], n, len(before))
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([after.tobytes(), before.tobytes()], pa.binary())],
            ["side", "sums"])
    return run


def _add(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x) for x in group["sums"])
    return pd.DataFrame({"side": group["side"].iloc[:1], "sums": [total.tobytes()]})


def _unit_classes(moving: np.ndarray) -> np.ndarray:
    tails = CLASSES + np.arange(TAIL_CLASSES)
    return np.concatenate((moving, tails, tails, [_END_CLASS]))


def likelihood(step: np.ndarray) -> float:
    """Log-likelihood of the training texts under the class model with these class
    transition counts, up to a constant that does not depend on the classes."""
    def entropy(x):
        x = x[x > 0]
        return float((x * np.log(x)).sum())

    return entropy(step) - entropy(step.sum(1)) - entropy(step.sum(0))


def _pull(step: np.ndarray) -> np.ndarray:
    """log of P(next class | this class) / P(next class)."""
    n = step.sum(1) + 1.0
    return np.log((step + 0.1) / (n[:, None] * n[None, :]))


def exchange(pairs: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, class transition counts, likelihood after each kept
    round) for the seeds.

    ``pairs``: (pair, n).  What reaches the driver is units by classes, a fixed
    size; the sums over bigrams are Spark's.
    """
    moving = np.arange(SEED_WORDS) % CLASSES
    kept, history, parts = None, [], 2
    for k in range(rounds + 1):
        classes = _unit_classes(moving)
        got = (pairs.mapInArrow(_contexts(classes), "side int, sums binary")
               .groupBy("side").applyInPandas(_add, "side int, sums binary").collect())
        sums = {r["side"]: np.frombuffer(r["sums"]).reshape(_UNITS, _ALL) for r in got}
        after = sums.get(0, np.zeros((_UNITS, _ALL)))
        before = sums.get(1, np.zeros((_UNITS, _ALL)))
        step = np.zeros((_ALL, _ALL))
        np.add.at(step, classes, before)
        now = likelihood(step)
        if kept is not None and now < history[-1]:
            parts *= 2  # undone; fewer words move at once from now on
        else:
            kept = moving, step, after, before
            history.append(now)
        moving, step, after, before = kept
        pull = _pull(step)
        gain = after[:SEED_WORDS] @ pull[:, :CLASSES] + before[:SEED_WORDS] @ pull[:CLASSES].T
        moving = np.where(np.arange(SEED_WORDS) % parts == k % parts, gain.argmax(1), moving)
    return _unit_classes(kept[0]), kept[1], history


def _neighbours(lexicon: Lexicon):
    """Texts -> (key, n): for every clustered word that is no seed, its neighbours, as
    ``word * 2 * units + unit`` before it and ``+ units`` after it.  Words are ranks;
    units are ranks, then the tail classes of words outside the vocabulary, then the end."""
    many = len(lexicon.words)
    units = many + TAIL_CLASSES + 1

    def run(batches):
        held, size = [], 0

        def flush():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])

        for b in batches:
            for h, tail, counts in _token_groups(b.column(0)):
                if not many:
                    continue
                at, known = lexicon.find(h)
                word = np.where(known, lexicon.rank[at], many + tail)
                unit, place = _laid_out(word, counts, units - 1)
                mine = np.flatnonzero(known & (word >= SEED_WORDS))
                key, place = word[mine].astype(np.int64) * (2 * units), place[mine]
                held += [key + unit[place - 1], key + units + unit[place + 1]]
                size += len(mine)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


_LINKS = "words binary, sizes binary, near binary, n binary"


def _packed(units: int):
    """Rows (key, n) in order -> rows of whole words: words, how many neighbours each
    has, the neighbours (those after it ``+ units``) and how often."""
    def pack(key, n):
        word = key // (2 * units)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        rows = np.unique(np.searchsorted(starts, np.arange(0, len(key), _ROW)))
        rows = np.append(rows[rows < len(starts)], len(starts))
        ends = np.append(starts, len(key))
        sizes = np.diff(ends)
        cols = [[], [], [], []]
        for a, b in zip(rows[:-1], rows[1:]):
            at = slice(ends[a], ends[b])
            for col, x in zip(cols, (word[starts[a:b]], sizes[a:b], key[at] - word[at] * (2 * units), n[at])):
                col.append(x.astype(np.int32).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in cols], ["words", "sizes", "near", "n"])

    def run(batches):
        held, size, most = [], 0, _ROW << 7
        for b in batches:
            held.append([b.column(i).to_numpy() for i in range(2)])
            size += b.num_rows
            if size < most:
                continue
            key, n = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(key, key[-1] // (2 * units) * (2 * units)))  # the last word may go on
            if cut:
                yield pack(key[:cut], n[:cut])
            held, size = [[key[cut:], n[cut:]]], len(key) - cut
            most = max(_ROW << 7, 2 * size)
        if size:
            yield pack(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The neighbours of every clustered word that is no seed, all of a word in one row."""
    units = len(lexicon.words) + TAIL_CLASSES + 1
    return (texts.mapInArrow(_neighbours(lexicon), "key long, n long")
            .repartition(F.expr(f"key div {2 * units}")).sortWithinPartitions("key")
            .mapInArrow(_packed(units), _LINKS))


def _flat(col) -> np.ndarray:
    """The numbers of all rows of a binary column."""
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int32)[col.offset: col.offset + len(col) + 1]
    return np.frombuffer(data, np.int32, (off[-1] - off[0]) // 4, off[0]) if len(col) else np.empty(0, np.int32)


class _Linked:
    """Functions over the rows of :func:`links`, with the classes of all words (by rank)."""

    def __init__(self, of: np.ndarray):
        self.many = len(of)
        self.of = np.concatenate((of, CLASSES + np.arange(TAIL_CLASSES + 1))).astype(np.uint8)

    def read(self, b):
        """(words, sizes, neighbours, whether they stand after the word, n)."""
        words, sizes, near, n = (_flat(b.column(i)) for i in range(4))
        after = near >= len(self.of)
        return words, sizes, near - after * np.int32(len(self.of)), after, n

    def steps(self, batches):
        """(pair of classes, n): each bigram that holds a word which is no seed, once."""
        total = np.zeros(_ALL * _ALL)
        for b in batches:
            words, sizes, near, after, n = self.read(b)
            own, other = np.repeat(self.of[words], sizes).astype(np.int64), self.of[near].astype(np.int64)
            total += np.bincount((own * _ALL + other)[after], n[after], len(total))
            # A clustered neighbour that is no seed has the bigram among its own.
            lone = ~after & ((near < SEED_WORDS) | (near >= self.many))
            total += np.bincount((other * _ALL + own)[lone], n[lone], len(total))
        yield _pairs_found(total)

    def moves(self, table: np.ndarray, least: int, parts: int, turn: int):
        """The class under which each moving word's contexts are likeliest, and the
        gains of the seeds by class from their neighbours that are no seeds."""
        width = 2 * _ALL

        def run(batches):
            seeds = np.zeros(SEED_WORDS * width)
            for k, b in enumerate(batches):
                words, sizes, near, after, n = self.read(b)
                hot = near < SEED_WORDS
                own = np.repeat(self.of[words], sizes)[hot]
                seeds += np.bincount(near[hot].astype(np.int64) * width + own + np.where(after[hot], 0, _ALL),
                                     n[hot], len(seeds))
                go = (words >= least) & (words % parts == turn)
                mine = np.repeat(go, sizes)
                words, sizes = words[go], sizes[go]
                context, n = self.of[near[mine]] + after[mine] * np.int64(_ALL), n[mine]
                ends = np.concatenate(([0], np.cumsum(sizes)))
                best = [np.empty(0, np.uint8)]
                for i in range(0, len(words), _WORDS):
                    j = min(i + _WORDS, len(words))
                    at = slice(ends[i], ends[j])
                    row = np.repeat(np.arange(j - i), sizes[i:j])
                    counts = np.bincount(row * width + context[at], n[at], (j - i) * width).reshape(-1, width)
                    best.append((counts @ table).argmax(1).astype(np.uint8))
                yield _part([_SLICES + k % _SLICES], [words.astype(np.int32).tobytes()], [np.concatenate(best).tobytes()])
            yield _gains(seeds, table)

        return run


class _Paired:
    """The same over bigrams of units, those of two seeds, rare words or ends."""

    def __init__(self, of: np.ndarray):
        seeds = np.zeros(SEED_WORDS, np.int64)
        seeds[:len(of)] = of[:SEED_WORDS]
        self.of = _unit_classes(seeds)

    def read(self, b):
        """(left unit, right unit, n)."""
        pair, n = (b.column(i).to_numpy() for i in range(2))
        left, right = pair // _UNITS, pair % _UNITS
        inside = SEED_WORDS + TAIL_CLASSES
        keep = ((left < inside) | (left == _END)) & ((right < inside) | (right == _END))
        return left[keep], right[keep], n[keep]

    def steps(self, batches):
        total = np.zeros(_ALL * _ALL)
        for b in batches:
            left, right, n = self.read(b)
            total += np.bincount(self.of[left] * _ALL + self.of[right], n, len(total))
        yield _pairs_found(total)

    def moves(self, table: np.ndarray):
        width = 2 * _ALL

        def run(batches):
            seeds = np.zeros(SEED_WORDS * width)
            for b in batches:
                left, right, n = self.read(b)
                for word, key in ((left, self.of[right] + _ALL), (right, self.of[left])):
                    hot = word < SEED_WORDS
                    seeds += np.bincount(word[hot] * width + key[hot], n[hot], len(seeds))
            yield _gains(seeds, table)

        return run


def _pairs_found(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], ["pair", "n"])


def _part(part: list[int], words: list[bytes], value: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(words, pa.binary()), pa.array(value, pa.binary())], ["part", "words", "value"])


def _gains(seeds: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    gain = np.split(seeds.reshape(SEED_WORDS, -1) @ table, _SLICES)
    return _part([*range(_SLICES)], [b""] * _SLICES, [x.tobytes() for x in gain])


_MOVED = "part int, words binary, value binary"


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """Gains are added, classes of words put one after another."""
    if group["part"].iloc[0] < _SLICES:
        return pd.DataFrame({"part": group["part"].iloc[:1], "words": [b""],
                             "value": [sum(np.frombuffer(x) for x in group["value"]).tobytes()]})
    return pd.DataFrame({"part": group["part"].iloc[:1], "words": [b"".join(group["words"])],
                         "value": [b"".join(group["value"])]})


class Vocabulary:
    """The exchange over all clustered words, from the bigrams of units and the
    neighbours of the words that are no seeds (:func:`links`).  What reaches the driver
    is a class per word and matrices of fixed size."""

    def __init__(self, pairs: DataFrame, near: DataFrame):
        self.pairs, self.near = pairs, near

    def steps(self, of: np.ndarray) -> np.ndarray:
        """Class transition counts under these classes (by rank)."""
        found = (self.near.mapInArrow(_Linked(of).steps, "pair long, n long")
                 .union(self.pairs.mapInArrow(_Paired(of).steps, "pair long, n long")))
        step = np.zeros(_ALL * _ALL)
        for r in found.groupBy("pair").agg(F.sum("n").alias("n")).collect():
            step[r["pair"]] = r["n"]
        return step.reshape(_ALL, _ALL)

    def moved(self, of: np.ndarray, step: np.ndarray, least: int = 0, parts: int = 1, turn: int = 0) -> np.ndarray:
        """The classes after the words from rank ``least`` on whose turn it is have moved."""
        pull = _pull(step)
        table = np.concatenate((pull[:, :CLASSES], pull[:CLASSES].T))  # context by class
        found = (self.near.mapInArrow(_Linked(of).moves(table, least, parts, turn), _MOVED)
                 .union(self.pairs.mapInArrow(_Paired(of).moves(table), _MOVED))
                 .groupBy("part").applyInPandas(_joined, _MOVED).collect())
        new, gain = of.copy(), [np.zeros((0, CLASSES))] * _SLICES
        for r in found:
            if r["part"] < _SLICES:
                gain[r["part"]] = np.frombuffer(r["value"]).reshape(-1, CLASSES)
            else:
                new[np.frombuffer(r["words"], np.int32)] = np.frombuffer(r["value"], np.uint8)
        seed = np.arange(min(SEED_WORDS, len(of)))
        go = (seed >= least) & (seed % parts == turn)
        new[seed[go]] = np.concatenate(gain).argmax(1)[seed[go]]
        return new

    def rounds(self, of: np.ndarray, step: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
        """(classes, transition counts, likelihood at first and after each kept round)."""
        history, parts = [likelihood(step)], 2
        for k in range(rounds):
            new = self.moved(of, step, parts=parts, turn=k % parts)
            after = self.steps(new)
            now = likelihood(after)
            if now < history[-1]:
                parts *= 2  # undone
            else:
                of, step = new, after
                history.append(now)
        return of, step, history


def sweep(texts: DataFrame, lexicon: Lexicon, classes: np.ndarray, step: np.ndarray, tail: np.ndarray,
          vocabulary: Vocabulary | None = None, rounds: int = 0) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each clustered word, class transition counts, likelihoods before, after
    the sweep and after each kept round): every word but the seeds is moved once, then
    all words in rounds.  ``tail`` has the words' tail classes, where they are before."""
    seed = lexicon.rank < SEED_WORDS
    of = np.where(seed, classes[np.where(seed, lexicon.rank, 0)], CLASSES + tail)
    history = [likelihood(step)]
    if seed.all():
        return of, step, history
    if vocabulary is None:
        pairs = texts.mapInArrow(_bigrams(lexicon), "pair long, n long")
        vocabulary = Vocabulary(pairs, links(texts, lexicon))
    ranked = np.empty_like(of)
    ranked[lexicon.rank] = of
    new = vocabulary.moved(ranked, step, least=SEED_WORDS)
    after = vocabulary.steps(new)
    if likelihood(after) >= history[0]:
        ranked, step = new, after
        history.append(likelihood(after))
    ranked, step, more = vocabulary.rounds(ranked, step, rounds)
    return ranked[lexicon.rank], step, history + more[1:]


def _least_count(words: DataFrame, tokens: int) -> int:
    """The least count of a clustered word: :data:`MIN_COUNT`, or more where more than
    1 / SHARE words have it."""
    most = max(MIN_COUNT, math.ceil(SHARE * tokens))  # at most 1 / SHARE words occur so often
    n = np.zeros(most + 1, np.int64)
    for r in (words.where(F.col("n") >= MIN_COUNT).groupBy(F.least("n", F.lit(most)).alias("n"))
              .agg(F.count("*").alias("v")).collect()):
        n[r["n"]] = r["v"]
    enough = np.cumsum(n[::-1])[::-1] <= 1 / SHARE
    return next(k for k in range(MIN_COUNT, most + 1) if enough[k] or k == most)


class Model:
    """Tables for scoring, of a size bounded by 1 / SHARE words."""

    def __init__(self, lexicon: Lexicon, of: np.ndarray, step: np.ndarray, tail_total: np.ndarray,
                 tail_words: np.ndarray, total: int, distinct: int, texts: int):
        self.lexicon, self.of = lexicon, of.astype(np.int16)
        n = step.sum(0)
        own = (n + 0.5) / (n.sum() + 0.5 * _ALL)
        self.step = np.log10((step + BACKOFF * own) / (step.sum(1, keepdims=True) + BACKOFF))
        self.floor = total + 0.5 * (distinct + 1)
        self.base = np.log10((lexicon.counts + 0.5) / self.floor)
        self.end_base = float(np.log10((texts + 0.5) / self.floor))
        self.end_known = int(texts > 0)
        # Emission: relative frequency in the class.  Words outside the vocabulary share
        # a tail class with the clustered words that stayed there; it keeps room for
        # unseen ones.
        of_class = np.zeros(_ALL)
        np.add.at(of_class, of, lexicon.counts)
        of_class[CLASSES:CLASSES + TAIL_CLASSES] += tail_total + 0.5 * (tail_words + 1)
        self.tail_floor = of_class[CLASSES:CLASSES + TAIL_CLASSES]
        self.emit = np.log10(lexicon.counts / of_class[of]) if len(of) else np.zeros(0)

    def score(self, h: np.ndarray, tail: np.ndarray, counts: np.ndarray):
        """Per row: (n_tokens, known, base, score, number of words to be joined), then
        those words' hashes, tails and counts, row after row."""
        rows = len(counts)
        at, known = self.lexicon.find(h)
        of_word = np.repeat(np.arange(rows), counts)
        words = np.where(known, self.of[at], CLASSES + tail) if len(self.of) else CLASSES + tail
        c, _ = _laid_out(words, counts, _END_CLASS)
        score = np.bincount(np.repeat(np.arange(rows), counts + 1), self.step[c[:-1], c[1:]], rows)
        k, of_known = at[known], of_word[known]
        base = np.bincount(of_known, self.base[k], rows) + self.end_base
        score += np.bincount(of_known, self.emit[k], rows)
        rest, of_rest = np.flatnonzero(~known), of_word[~known]
        order = rest[np.lexsort((h[rest], of_rest))]
        new = np.ones(len(order), bool)
        new[1:] = (h[order[1:]] != h[order[:-1]]) | (of_word[order[1:]] != of_word[order[:-1]])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(order)))
        first = order[first]
        return (counts + 1, np.bincount(of_known, minlength=rows) + self.end_known, base, score,
                np.bincount(of_word[first], minlength=rows), h[first], tail[first], n)


_SCORED = ("row long, doc_id long, n_tokens long, known long, base double, score double, "
           "rest array<struct<word:bigint,tail:int,n:bigint>>")


def _scorer(model: Model):
    def run(batches):
        # Each row gets a number of its own; written once, so it is never made twice.
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            ids = b.column(0)
            found = [model.score(*g) for g in _token_groups(b.column(1))]
            kinds = (np.int64, np.int64, np.float64, np.float64, np.int64, np.uint64, np.int64, np.int64)
            cols = [np.concatenate([np.empty(0, k), *(f[i] for f in found)]) for i, k in enumerate(kinds)]
            cut = np.concatenate(([0], np.cumsum(cols[4])))
            rest = pa.StructArray.from_arrays(
                [pa.array(cols[5].view(np.int64)), pa.array(cols[6], pa.int32()), pa.array(cols[7])],
                ["word", "tail", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(ids)), pa.int64()), ids, *(pa.array(c) for c in cols[:4]),
                 pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rest)],
                ["row", "doc_id", "n_tokens", "known", "base", "score", "rest"])
            row += len(ids)
    return run


def train(texts: DataFrame, scratch: Scratch) -> tuple[Model, DataFrame, int]:
    """(model, counts of all words, training tokens) from (text)."""
    counts = scratch.save(
        texts.mapInArrow(_count_words, "word long, tail long, n long")
        .groupBy("word", "tail").agg(F.sum("n").alias("n")), "counts")
    marks = counts.where("tail < 0").agg(F.sum("n")).first()[0] or 0
    words = counts.where("tail >= 0")
    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = (total["n"] or 0) + marks, total["v"] + int(marks > 0)
    least = _least_count(words, tokens)
    top = words.where(F.col("n") >= least).select("word", "tail", "n").toArrow()
    top = top.sort_by([("n", "descending"), ("word", "ascending")])
    word, tail, n = (top.column(c).to_numpy() for c in ("word", "tail", "n"))
    lexicon = Lexicon(word.view(np.uint64), n.astype(np.float64))
    tail = tail[np.argsort(word.view(np.uint64))].astype(np.int16)
    del top, word, n
    tails = np.zeros((2, TAIL_CLASSES))
    for r in words.where(F.col("n") < least).groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tails[:, r["tail"]] = r["n"], r["v"]
    pairs = scratch.save(
        texts.mapInArrow(_bigrams(lexicon), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    classes, step, _ = exchange(pairs)
    vocabulary = None
    if len(lexicon.words) > SEED_WORDS:
        vocabulary = Vocabulary(pairs, scratch.save(links(texts, lexicon), "links"))
    of, step, _ = sweep(texts, lexicon, classes, step, tail, vocabulary, ROUNDS)
    scratch.drop("pairs", "links")
    return Model(lexicon, of, step, tails[0], tails[1], tokens, distinct, marks), words, tokens


def score(docs: DataFrame, training: Column, scratch: Scratch, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per
    row of ``docs``; rows where ``training`` holds are learned from."""
    bounded_batches(docs.sparkSession)
    model, words, tokens = train(docs.where(training).select(text_col), scratch)
    rows = scratch.save(docs.select(F.col(id_col).cast("long"), F.col(text_col))
                        .mapInArrow(_scorer(model), _SCORED), "scored")
    floors = F.array(*[F.lit(float(x)) for x in model.tail_floor])
    seen = F.coalesce(F.col("count"), F.lit(0)) + 0.5
    rest = (rows.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.tail", "r.n")
            .join(words.select("word", F.col("n").alias("count")), "word", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("count").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
                F.sum(F.col("n") * F.log10(seen / F.lit(model.floor))).alias("more_base"),
                F.sum(F.col("n") * F.log10(seen / F.element_at(floors, F.col("tail") + 1))).alias("more_score")))
    zero = F.lit(0)
    return rows.drop("rest").join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
