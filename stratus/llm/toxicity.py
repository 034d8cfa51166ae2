"""Toxicity by subword-bag embeddings and a linear softmax.

Every character n-gram (3 to 5 characters, with word ends) has a vector in a
hashed table; a word is the mean of its n-grams' vectors, a passage of
``PASSAGE`` words the mean of its words, and a softmax over two classes reads
it.  Table and softmax are trained jointly in numpy (Adam).  A document is as
toxic as its worst passage, so a few words weigh the same in a long text as in
a short one.  Unseen misspellings share n-grams with seen words.

Training rows: a hash-chosen sample of at most ``max_train`` labelled documents
(a parameter).  Scoring covers every whole text: as the softmax is linear, each
n-gram contributes one number, and a text is scored by gathers and sums.

Edge cases: null and empty texts (and white space alone) score like a passage
without words, by the bias; null labels and null ids are not trained on; a text
labelled twice with both labels counts as toxic; repeated rows score alike;
without any labelled row of both classes every score is the share of toxic
labels (0 without labels).
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.scratch import bounded_batches
from stratus.llm.words import hash_words, text_buffers

#: Labelled documents used for fitting, at most.
MAX_TRAIN = 4000
#: Hashed rows of the embedding table, and their length.
BUCKETS, DIM = 1 << 17, 8
#: Training steps, and how much a toxic document counts against a clean one.
EPOCHS, TOXIC_WEIGHT = 80, 3.0
#: Words per passage.
PASSAGE = 4
#: Characters scored at once; a longer text goes in several pieces.
CHUNK = 1 << 17
#: Bytes, grams or words of the training texts looked at together.
FIT_BLOCK = 1 << 18
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
_SPIN = np.array([0x2C1B3C6D, 0x297A2D39, 0xB55A4F09], np.uint32)
_BITS = np.uint32(32 - 17)


def codes(raw: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes, A-Z lower-cased, ASCII white space as 0x20."""
    c = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).copy()
    c[(c >= 9) & (c <= 13)] = 32
    c[(c >= 65) & (c <= 90)] += 32
    return c


def _words(c: np.ndarray):
    """(starts, lengths) of the words of a code array that ends with a space."""
    gap = c == 32
    before = np.concatenate(([True], gap[:-1]))
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(gap & ~before)
    return starts, ends - starts


def _grams(c: np.ndarray):
    """For n = 3, 4, 5: (position of the gram's second character, bucket).

    A gram may begin or end with the space beside a word, but holds none inside.
    """
    x = np.concatenate((np.array([32], np.uint32), c, np.full(4, 32, np.uint32)))
    n = len(c)
    inner = x[1: n + 1] != 32
    h = x[:n] * _MULT[0] + x[1: n + 1] * _MULT[1] + x[2: n + 2] * _MULT[2]
    for k in range(3):
        if k:
            inner = inner & (x[1 + k: n + 1 + k] != 32)
            h = h + x[2 + k: n + 2 + k] * _MULT[2 + k]
        at = np.flatnonzero(inner)
        v = h[at]
        v = (v ^ (v >> np.uint32(15))) * _SPIN[k]
        yield at, v >> _BITS


def _gram_count(length: np.ndarray) -> np.ndarray:
    return length + np.maximum(length - 1, 0) + np.maximum(length - 2, 0)


def _pieces(raw: np.ndarray):
    """Code arrays of a text, cut at white space, each ending with a space."""
    c = codes(raw)
    at = 0
    while at < len(c):
        end = min(at + CHUNK, len(c))
        if end < len(c):
            gaps = np.flatnonzero(c[end:] == 32)
            end = end + int(gaps[0]) + 1 if len(gaps) else len(c)
        yield np.append(c[at:end], np.uint32(32))
        at = end


def word_values(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean over each word's n-grams of the table's number."""
    starts, length = _words(c)
    if not len(starts):
        return np.empty(0)
    total = np.zeros(len(c))
    for at, bucket in _grams(c):
        total[at] += np.take(table, bucket, mode="clip")
    return np.add.reduceat(total, starts) / _gram_count(length)


def worst_passage(values: np.ndarray, size: int = PASSAGE) -> float:
    """Largest mean over half-overlapping passages; 0 without words."""
    n = len(values)
    if n == 0:
        return 0.0
    if n <= size:
        return float(values.mean())
    first = np.arange(0, n - size + 1, size // 2)
    first = np.append(first, n - size)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return float(((total[first + size] - total[first]) / size).max())


@dataclass
class Model:
    """What scoring needs: a number per n-gram and the bias (toxic minus clean)."""

    table: np.ndarray = field(repr=False)
    bias: float = 0.0

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, table=self.table, bias=np.float64(self.bias))
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes) -> "Model":
        z = np.load(io.BytesIO(data))
        return Model(z["table"], float(z["bias"]))

    def score(self, raw: np.ndarray) -> float:
        parts = [word_values(c, self.table) for c in _pieces(raw)]
        z = worst_passage(np.concatenate(parts) if parts else np.empty(0)) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs (first, end) of rows of about ``most`` together; a larger row goes alone."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, "right")))
        yield at, end
        at = end


def _vocabulary(raws: list[np.ndarray]):
    """(hashes of the distinct words in ascending order, gram bounds per word, bucket
    of each gram).  Texts go in blocks; a word's letters are kept where it is new."""
    words, kept, letters, sizes = np.empty(0, np.uint64), [], [], []
    for lo, hi in _blocks(np.array([len(r) for r in raws]), FIT_BLOCK):
        text = np.concatenate([np.append(codes(r), np.uint32(32)) for r in raws[lo:hi]])
        starts, length = _words(text)
        found, first = np.unique(np.concatenate([hash_words(r)[0] for r in raws[lo:hi]]), return_index=True)
        at = np.searchsorted(words, found)
        new = np.append(words, np.uint64(0))[at] != found
        new |= at == len(words)
        words = np.insert(words, at[new], found[new])
        kept.append(found[new])
        starts, size = starts[first[new]], length[first[new]] + 1
        sizes.append(size)
        letters.append(text[_expand(starts, size)])
    order, size, letters = np.argsort(np.concatenate(kept)), np.concatenate(sizes), np.concatenate(letters)
    starts, size = (np.cumsum(size) - size)[order], size[order]
    gram_cut = np.concatenate(([0], np.cumsum(_gram_count(size - 1))))
    buckets = np.empty(gram_cut[-1], np.int32)
    for lo, hi in _blocks(size, FIT_BLOCK):
        grams = [np.stack(g) for g in _grams(letters[_expand(starts[lo:hi], size[lo:hi])])]
        at, bucket = np.concatenate(grams, axis=1)
        buckets[gram_cut[lo]: gram_cut[hi]] = bucket[np.argsort(at, kind="stable")]  # by position, so by word
    return words, gram_cut, buckets


def _features(raws: list[np.ndarray]):
    """Passages of the training texts over a vocabulary of distinct words:
    (passage bounds per document, word bounds per passage, word of each entry,
    gram bounds per word, bucket of each gram)."""
    words, gram_cut, buckets = _vocabulary(raws)
    passages, sizes, entries = [], [], []
    for r in raws:
        word = np.searchsorted(words, hash_words(r)[0]).astype(np.int32)
        n = len(word)
        first = np.arange(0, max(1, n - PASSAGE + 1), PASSAGE // 2)
        if n > PASSAGE:
            first = np.append(first, n - PASSAGE)
        size = np.full(len(first), min(n, PASSAGE))
        passages.append(len(first))
        sizes.append(size.astype(np.int32))
        entries.append(word[_expand(first, size)])
    return (np.concatenate(([0], np.cumsum(passages))),
            np.concatenate(([0], np.cumsum(np.concatenate(sizes), dtype=np.int64))),
            np.concatenate(entries), gram_cut, buckets)


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ranges first[i] .. first[i] + count[i]."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def fit(raws: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1,
        decay: float = 2e-5, toxic_weight: float = TOXIC_WEIGHT, seed: int = 7) -> Model:
    """Joint training of the n-gram table and the softmax on whole texts.

    Each step: all passages forward, each document by its worst passage,
    cross-entropy, gradients back to the chosen passages' n-grams, Adam.
    """
    y = np.asarray(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(BUCKETS, np.float32), float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30)))
    doc_cut, passage_cut, entries, gram_cut, buckets = _features(raws)
    word_blocks = list(_blocks(np.diff(gram_cut), FIT_BLOCK))
    seen = np.zeros(BUCKETS, bool)
    for lo, hi in word_blocks:
        seen[buckets[gram_cut[lo]: gram_cut[hi]]] = True
    used, place = np.flatnonzero(seen), np.cumsum(seen, dtype=np.int32) - 1
    for lo, hi in word_blocks:
        buckets[gram_cut[lo]: gram_cut[hi]] = place[buckets[gram_cut[lo]: gram_cut[hi]]]
    doc_blocks = list(_blocks(np.diff(passage_cut[doc_cut]), FIT_BLOCK))
    grams, words_in = np.diff(gram_cut), np.diff(passage_cut)
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32),
         "w": rng.normal(0, 0.5, (DIM, 2)).astype(np.float32),
         "b": np.zeros(2, np.float32)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    share = y.mean()
    p["b"][1] = np.log(share / (1 - share))
    for step in range(1, epochs + 1):
        # The softmax is linear: every passage's margin needs one number a gram.
        number = (p["e"] @ (p["w"][:, 1] - p["w"][:, 0])).astype(np.float64)
        per_word = np.concatenate([np.empty(0)] + [
            np.add.reduceat(number[buckets[gram_cut[lo]: gram_cut[hi]]], gram_cut[lo:hi] - gram_cut[lo]) / grams[lo:hi]
            for lo, hi in word_blocks])
        carry, best, chosen = 0.0, [], []
        for lo, hi in doc_blocks:
            first, end = doc_cut[lo], doc_cut[hi]
            cut = passage_cut[first: end + 1]
            total = np.cumsum(np.concatenate(([carry], per_word[entries[cut[0]: cut[-1]]])))
            carry, cut = total[-1], cut - cut[0]
            margin = (total[cut[1:]] - total[cut[:-1]]) / np.maximum(words_in[first:end], 1)
            worst = np.maximum.reduceat(margin, doc_cut[lo:hi] - first)
            of_doc = np.repeat(np.arange(lo, hi), np.diff(doc_cut[lo: hi + 1]))
            hits = np.flatnonzero(margin == worst[of_doc - lo])
            chosen.append(first + hits[np.unique(of_doc[hits], return_index=True)[1]])  # a document's first worst passage
            best.append(worst)
        best, chosen = np.concatenate(best), np.concatenate(chosen)
        best = best + p["b"][1] - p["b"][0]
        prob = 1 / (1 + np.exp(-np.clip(best, -60, 60)))
        gz = (((prob - y) * np.where(y > 0, toxic_weight, 1.0) / len(y))[:, None] * np.array([[-1, 1]])).astype(np.float32)
        # Vectors forward and back for the chosen passages alone.
        n = words_in[chosen]
        word = entries[_expand(passage_cut[chosen], n)]
        doc = np.repeat(np.arange(len(y)), n)
        gram = buckets[_expand(gram_cut[word], grams[word])]
        weight = np.repeat(1.0 / (n[doc] * grams[word]), grams[word])
        doc = np.repeat(doc, grams[word])
        x = np.stack([np.bincount(doc, weight * p["e"][gram, j], len(y)) for j in range(DIM)], 1)
        gx = gz @ p["w"].T
        ge = np.stack([np.bincount(gram, weight * gx[doc, j], len(used)) for j in range(DIM)], 1)
        g = {"w": (x.T @ gz).astype(np.float32), "b": gz.sum(0),
             "e": ge.astype(np.float32) + decay * p["e"]}
        for key in p:
            m[key] = 0.9 * m[key] + 0.1 * g[key]
            s[key] = 0.999 * s[key] + 0.001 * g[key] ** 2
            p[key] -= rate * (m[key] / (1 - 0.9 ** step)) / (np.sqrt(s[key] / (1 - 0.999 ** step)) + 1e-8)
    table = np.zeros(BUCKETS, np.float32)
    table[used] = p["e"] @ (p["w"][:, 1] - p["w"][:, 0])
    return Model(table, float(p["b"][1] - p["b"][0]))


def _fitter(batches):
    """All training rows (id, text, label) of one task -> the packed model."""
    rows = [b for b in batches if b.num_rows]
    texts = [raw for b in rows for raw in text_buffers(b.column(1))]
    labels = np.concatenate([b.column(2).to_numpy() for b in rows]) if rows else np.empty(0)
    yield pa.RecordBatch.from_arrays([pa.array([fit(texts, labels).pack()], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled documents, those with the lowest
    hashes of their ids, in one task (the sample is bounded); the driver gets
    the finished table."""
    bounded_batches(docs.sparkSession)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y")))
    chosen = known.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(max_train)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]))
    made = (rows.select("_id", "_text", "_y").repartition(1).sortWithinPartitions("_id")
            .mapInArrow(_fitter, "model binary").first())
    return Model.unpack(bytes(made["model"])) if made else fit([], np.empty(0))


def score(text: Column, model: Model) -> Column:
    """Probability of the toxic class, from the whole text."""
    packed = model.pack()

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model.unpack(packed)
        for b in batches:
            yield pa.array([m.score(raw) for raw in text_buffers(b)], pa.float64())

    return of(text)


def fold(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in no fold (-1)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(-1))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored below ``threshold``, columns unchanged.  Labels of
    fold 0 are held out of the training."""
    model = train(docs, labels.where(fold("doc_id") != 0))
    return docs.where(score(F.col("text"), model) < threshold)
