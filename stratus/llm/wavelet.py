"""Token-id files as wavelet matrices.

Documents are tokenised, an end id is appended to each, and the ids of a shard
(a run of documents in ascending id order) are stored as a wavelet matrix: one
bit plane per bit of the largest id, each plane the stable partition of the one
above.  A plane is cut into blocks, each a zstd frame of its own; the file's head
holds every frame's place and the number of ones before it (the rank directory),
so a question reads a few blocks and not the shard.  From one compressed image
this answers

* :meth:`WaveletMatrix.access`: the id at a position,
* :meth:`WaveletMatrix.rank` and ``count``: how often an id occurs before a position,
* :meth:`WaveletMatrix.select`: where its k-th occurrence is,

each in one step per plane.  A shard is a row of a Parquet table, written one
file per task: ``shard, first_doc, n_docs, n_tokens, doc_ids, doc_tokens,
image``.  :func:`tokens_at` and :func:`occurrences` ask all shards of a table.

Edge cases: null and empty texts are documents of the end id alone; repeated
rows are all written (in order of id, then of a hash of the text); a null id sorts first; an
empty table gives no shard.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch, bounded_batches
from stratus.llm.words import is_space, mix, powers, text_buffers

#: Bytes of text in a shard, about; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
#: Pieces of text whose ids a worker remembers (only speed depends on it).
REMEMBERED = 1_200_000
#: Bytes of text cut at once (a longer word is cut whole).
PIECE = 1 << 20
#: Bits in a block of a plane.
BLOCK = 1 << 16
_MAGIC = b"WVLT2\0\0\0"

SCHEMA = ("shard long, first_doc long, n_docs long, n_tokens long, "
          "doc_ids array<long>, doc_tokens array<long>, image binary")


class Plane:
    """A bit plane in blocks that are loaded when they are asked for.

    ``before`` has the ones before each block, and all of them at the end."""

    def __init__(self, n: int, size: int, before: np.ndarray, load: Callable[[int], np.ndarray]):
        self.n, self.size, self.before, self._load = n, size, before, load
        self.loaded: dict[int, np.ndarray] = {}

    def block(self, k: int) -> np.ndarray:
        if k not in self.loaded:
            self.loaded[k] = self._load(k)
        return self.loaded[k]

    def bit(self, i: int) -> int:
        k, at = divmod(i, self.size)
        return int(self.block(k)[at // 8] >> (7 - at % 8)) & 1

    def ones(self, i: int) -> int:
        """Ones before position ``i``."""
        k, at = divmod(i, self.size)
        count = int(self.before[k])
        if at:
            part = self.block(k)
            count += int(np.bitwise_count(part[: at // 8]).sum())
            if at % 8:
                count += int(part[at // 8] >> (8 - at % 8)).bit_count()
        return count

    def place(self, k: int, bit: int) -> int:
        """Position of the k-th (from 0) one or zero."""
        before = self.before if bit else np.minimum(np.arange(len(self.before)) * self.size, self.n) - self.before
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.block(block))
        return block * self.size + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def whole(self) -> np.ndarray:
        """All bits, packed."""
        return np.concatenate([self.block(k) for k in range(len(self.before) - 1)] or [np.empty(0, np.uint8)])


def _plane(packed: np.ndarray, n: int, size: int) -> Plane:
    step = size // 8
    starts = range(0, len(packed), step)
    per = [int(np.bitwise_count(packed[a: a + step]).sum()) for a in starts]
    return Plane(n, size, np.concatenate(([0], np.cumsum(per, dtype=np.int64))), lambda k: packed[k * step: (k + 1) * step])


class WaveletMatrix:
    """A sequence of non-negative integers below 2**32."""

    def __init__(self, planes: list[Plane], zeros: np.ndarray, n: int):
        self.n, self.planes, self.zeros = n, planes, zeros

    @staticmethod
    def build(ids: np.ndarray, block: int = BLOCK) -> "WaveletMatrix":
        planes, zeros = [], []
        width = int(ids.max()).bit_length() if len(ids) else 0
        kind = np.uint16 if width <= 16 else np.uint32
        now, other = ids.astype(kind), np.empty(len(ids), kind)
        for b in reversed(range(width)):
            bit = (now & kind(1 << b)).astype(bool)
            planes.append(_plane(np.packbits(bit), len(ids), block))
            z = len(ids) - int(np.count_nonzero(bit))
            zeros.append(z)
            if b:  # nothing is below the last plane
                np.compress(bit, now, out=other[z:])
                np.compress(~bit, now, out=other[:z])
                now, other = other, now
        return WaveletMatrix(planes, np.array(zeros, np.int64), len(ids))

    def to_bytes(self) -> bytes:
        """Magic, sizes (ids, planes, bits in a block), zeros of each plane, the directory
        (per plane, ones before each block), the frames' ends, then the frames."""
        pack = zstandard.ZstdCompressor(level=3).compress
        frames = [[pack(p.block(k).tobytes()) for k in range(len(p.before) - 1)] for p in self.planes]
        ends = np.cumsum([len(f) for fs in frames for f in fs], dtype=np.int64)
        block = self.planes[0].size if self.planes else BLOCK
        head = np.concatenate(([self.n, len(self.planes), block, *self.zeros], *(p.before for p in self.planes), ends))
        return b"".join((_MAGIC, head.astype("<u8").tobytes(), *(f for fs in frames for f in fs)))

    @staticmethod
    def from_bytes(data: bytes) -> "WaveletMatrix":
        if data[:8] != _MAGIC:
            raise ValueError("not a wavelet matrix")
        n, k, size = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        blocks = -(-n // size)
        head = np.frombuffer(data, "<u8", k + k * (blocks + 1) + k * blocks, 32).astype(np.int64)
        zeros, before = head[:k], head[k: k + k * (blocks + 1)].reshape(k, blocks + 1)
        ends = np.concatenate(([0], head[k + k * (blocks + 1):])) + 32 + 8 * len(head)
        view = memoryview(data)
        unpack = zstandard.ZstdDecompressor().decompress

        def loader(level: int):
            def load(block: int) -> np.ndarray:
                i = level * blocks + block
                raw = unpack(view[ends[i]: ends[i + 1]], max_output_size=size // 8)
                return np.frombuffer(raw, np.uint8)

            return load

        return WaveletMatrix([Plane(n, size, before[i], loader(i)) for i in range(k)], zeros, n)

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane, z in zip(self.planes, self.zeros):
            bit, ones = plane.bit(i), plane.ones(i)
            value = value * 2 + bit
            i = int(z) + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` in [lo, hi) end up below the last plane."""
        k = len(self.planes)
        if value >> k or value < 0:
            return 0, 0
        for level, (plane, z) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.ones(lo), plane.ones(hi)
            lo, hi = (int(z) + a, int(z) + b) if value >> (k - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` before position ``i``."""
        lo, hi = self._range(value, 0, i)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Position of the occurrence number ``k`` (from 0) of ``value``."""
        lo, hi = self._range(value, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = self.planes[level].place(at - int(self.zeros[level]) if bit else at, bit)
        return at

    def decode(self) -> np.ndarray:
        """All ids, in order: the planes are merged from the last one up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for b, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane.whole(), count=self.n).view(bool)
            z = int(self.zeros[len(self.planes) - 1 - b])
            up = np.empty(self.n, kind)
            up[~bit] = now[:z]
            up[bit] = now[z:] | kind(1 << b)
            now = up
        return now.astype(np.uint32)


# --- tokenising ----------------------------------------------------------------
#: What a byte (A-Z lower-cased) is: white space, part of a Latin-1 letter, a mark, or
#: anything else.  Apostrophes and digits are cut otherwise by the tokenizer, and
#: special tokens begin with "<": words with those are not cut.
_SPACE, _LETTERS, _MARKS, _OTHER = range(4)
_C3 = 0xC3  # first byte of the letters from U+00C0 on
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[is_space(np.arange(256))] = _SPACE
_KIND[97:123] = _LETTERS
_KIND[_C3] = _LETTERS
_KIND[[c for a, b in ((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
       for c in range(a, b + 1) if c != 0x3C]] = _MARKS
_VALUE = np.random.default_rng(20240831).integers(1, (1 << 64) - 1, 256, dtype=np.uint64, endpoint=True)


def cut(data: np.ndarray, rows: np.ndarray, simple: bool = True):
    """Pieces of texts laid end to end (``rows``: their starts): (start, end, kind, hash,
    bytes to read pieces from).

    A word of Latin-1 letters and marks only is cut into runs of either, lower-cased:
    the tokenizer's own units.  Any other word is one piece as it stands.
    """
    n = len(data)
    after = np.zeros(n, bool)
    np.equal(data[:-1], _C3, out=after[1:])
    text = _FOLD[data]
    text[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32  # capitals
    kind = _KIND[text]
    kind[after & (text >= 0x9F) & (text <= 0xBF) & (text != 0xB7)] = _LETTERS
    full = kind != _SPACE
    first = np.ones(n, bool)
    np.logical_not(full[:-1], out=first[1:])
    first[rows[rows < n]] = True
    first &= full
    words = np.flatnonzero(first)
    if not len(words):
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint8), none.astype(np.uint64), text
    odd = np.logical_or.reduceat(kind == _OTHER, words) if simple else np.ones(len(words), bool)
    if odd.any():
        inside = np.zeros(n, bool)
        inside[words[0]:] = np.repeat(odd, np.diff(np.append(words, n)))
        inside &= full
        kind[inside] = _OTHER
        text = np.where(inside, data, text)
    begin = first
    begin[1:] |= full[1:] & (kind[1:] != kind[:-1])
    stop = full.copy()
    stop[:-1] &= begin[1:] | ~full[1:]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[text] * up[:n], out=total[1:])
    return start, end, kind[start], mix((total[end] - total[start]) * down[start]), text


class Encoder:
    """Ids of whole texts; the ids of pieces met before are remembered.

    A text is cut at ASCII white space, which the tokenizer drops and never
    joins tokens across, so encoding word by word gives the same ids.  Runs of
    letters and of marks (see :func:`cut`) go straight to the tokenizer's merge
    model, past its normaliser and splitter.  Both shortcuts are tried on probes
    first; a tokenizer that answers otherwise gets whole words, or whole texts.
    Pieces are told apart by a 64-bit hash.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # How the byte-level alphabet writes each letter of a run.
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        self.alphabet = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        probe = ["one two", "don't  3 4's", "a.b\n\tc", "\u00c9t\u00e9, d\u00eftes... ab-c"]
        self.by_word = all(
            self._plain([x])[0].tolist()
            == [i for w in self._plain(x.split()) for i in w.tolist()] for x in probe)
        self.simple = True
        self._forget()
        words = ["The", "Stra\u00dfe,", "\u00c9t\u00e9...", "abcxyz!?", "x", "\u00f8re)", "(a.b)-[c]:;", "\u00c0\u00de\u00ffz",
                 "".join(map(chr, (*range(0x21, 0x27), *range(0x28, 0x30)))), ":=>?@[\\]^_`{|}~"]
        self.simple = self.by_word and all(
            self.encode(pa.array([w]))[0].tolist() == self._plain([w])[0].tolist() for w in words)
        self._forget()

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        """No piece is known: their hashes in order and the number of each, their ids one
        after the other, and where each piece's end.  Arrays, as a worker keeps them."""
        self.hashes, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.flat, self.ends = array("I"), array("q", [0])

    def _number(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces; -1 where one is not known."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at].astype(np.int64), -1)

    def _learn(self, hashes: np.ndarray, pieces: list[str], kinds: list[int]) -> None:
        whole = iter(self._plain([p for p, k in zip(pieces, kinds) if k == _OTHER]))
        tokenize, alphabet = self.model.tokenize, self.alphabet
        found = [next(whole).tolist() if k == _OTHER else
                 [t.id for t in tokenize(p if p.isascii() else p.translate(alphabet))]
                 for p, k in zip(pieces, kinds)]
        n = len(self.ends) - 1
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.numbers = np.insert(self.numbers, at, np.arange(n, n + len(found)))
        self.ends.extend((len(self.flat) + np.cumsum([len(x) for x in found])).tolist())
        self.flat.extend(chain.from_iterable(found))

    def _pieces(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row) of texts laid end to end."""
        start, end, kind, h, text = cut(data, rows, self.simple)
        distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED:
            self._forget()
        known = self._number(distinct)
        new = np.flatnonzero(known < 0)
        if len(new):
            raw, where, n = text.tobytes(), at[new], len(self.ends) - 1
            self._learn(distinct[new],
                        [raw[a:b].decode() for a, b in zip(start[where].tolist(), end[where].tolist())],
                        kind[where].tolist())
            known[new] = np.arange(n, n + len(new))
        known = known[back]
        ends = np.frombuffer(self.ends, np.int64)
        n = ends[known + 1] - ends[known]
        to = np.concatenate(([0], np.cumsum(n)))
        take = np.arange(to[-1]) + np.repeat(ends[known] - to[:-1], n)
        ids = np.frombuffer(self.flat, np.uint32)[take] if len(take) else np.empty(0, np.uint32)
        return ids, np.diff(to[np.searchsorted(start, np.append(rows, len(data)))])

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per row); a null counts as empty."""
        if not self.by_word:
            found = self._plain([t or "" for t in texts.to_pylist()])
            return np.concatenate([np.empty(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        ids, counts, held, size = [], [], [], 0

        def flush():
            rows = np.cumsum([0, *map(len, held)])
            found, per_row = self._pieces(np.concatenate(held), rows[:-1])
            ids.append(found)
            counts.append(per_row)

        for b in text_buffers(texts):
            if held and size + len(b) > PIECE:
                flush()
                held, size = [], 0
            if len(b) <= PIECE:
                held.append(b)
                size += len(b)
                continue
            found = [self._pieces(part, np.zeros(1, np.int64))[0] for part in _parts(b)]
            ids += found
            counts.append(np.array([sum(map(len, found))]))
        if held:
            flush()
        return (np.concatenate([np.empty(0, np.uint32), *ids]), np.concatenate([np.empty(0, np.int64), *counts]))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """One id array per text."""
        ids, counts = self.encode_rows(texts)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of about PIECE bytes, cut before white space."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not is_space(data[end: end + 1])[0]:
            stop = min(end + PIECE, len(data))
            gaps = np.flatnonzero(is_space(data[end:stop]))
            end = end + int(gaps[0]) if len(gaps) else stop
        yield data[at:end]
        at = end


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: it stays, with its words, from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _writer(path: str, end_id: int):
    """Rows (doc_id, text) of one shard, sorted -> its row.  The shard's number
    is the range partition's."""
    def run(batches):
        shard = TaskContext.get().partitionId()
        enc = encoder(path)
        docs, ids, counts = [], [], []
        for b in batches:
            found, n = enc.encode_rows(b.column(1))
            docs.append(b.column(0))
            counts.append(n + 1)
            last = np.cumsum(n + 1) - 1
            inside = np.ones(len(found) + len(n), bool)
            inside[last] = False
            with_ends = np.full(len(inside), end_id, np.uint32)
            with_ends[inside] = found
            ids.append(with_ends)
        if not sum(map(len, docs)):
            return
        docs, n, all_ids = pa.concat_arrays(docs), pa.array(np.concatenate(counts), pa.int64()), np.concatenate(ids)
        one = pa.array([0, len(docs)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), docs.slice(0, 1), pa.array([len(docs)], pa.int64()),
             pa.array([len(all_ids)], pa.int64()), pa.ListArray.from_arrays(one, docs),
             pa.ListArray.from_arrays(one, n),
             pa.array([WaveletMatrix.build(all_ids).to_bytes()], pa.binary())],
            ["shard", "first_doc", "n_docs", "n_tokens", "doc_ids", "doc_tokens", "image"])

    return run


def write_shards(docs: DataFrame, scratch: Scratch, path: str, end_id: int, name: str = "shards",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Tokenise (doc_id, text) and write the shard table; returns it read back.

    Texts are range-partitioned by id (ties by a hash of the text, so that a
    repeated id may go on in the next shard); each partition is one shard, one
    task and one file.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id"), F.xxhash64("text")]
    made = (base.repartitionByRange(max(1, -(-size // shard_bytes)), *order)
            .sortWithinPartitions(*order, "text").mapInArrow(_writer(path, end_id), SCHEMA))
    return scratch.save(made, name)


def starts(shards: DataFrame, per_group: int = 1000) -> DataFrame:
    """(shard, base): tokens of all shards before each, in two levels, so that
    no task sums more than a thousand shards (or a thousandth of them)."""
    group = F.floor(F.col("shard") / per_group)
    sizes = shards.select("shard", "n_tokens", group.alias("g"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("g").agg(F.sum("n_tokens").alias("n")).select(
        "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("g_base"))
    return sizes.join(groups, "g").select(
        "shard", (F.col("g_base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("base"))


def _reader(batches):
    """Shard rows -> (doc_id, start, n_tokens, ids_crc32), ids decoded from the image."""
    for b in batches:
        for r in range(b.num_rows):
            ids = WaveletMatrix.from_bytes(b.column("image")[r].as_py()).decode()
            n = np.array(b.column("doc_tokens")[r].as_py(), np.int64)
            end = np.cumsum(n)
            raw = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * (e - k): 4 * e]) for e, k in zip(end, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_ids")[r].values, pa.array(end - n + b.column("base")[r].as_py(), pa.int64()),
                 pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a shard table."""
    rows = shards.select("shard", "doc_ids", "doc_tokens", "image").join(starts(shards), "shard")
    return rows.select("doc_ids", "doc_tokens", "image", "base").mapInArrow(
        _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_at(shards: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token) for the global ``position`` s that exist, by access: each
    reads one block per plane of its shard."""
    place = starts(shards)
    shard_of = shards.select("shard", "n_tokens", "image").join(place, "shard")
    group = F.floor(F.col("position") / _SPAN)
    ranges = shard_of.select("shard", "base", "n_tokens", F.explode(F.sequence(
        F.floor(F.col("base") / _SPAN), F.floor((F.col("base") + F.col("n_tokens") - 1) / _SPAN))).alias("g"))
    asked = (positions.select("position", group.alias("g")).join(ranges, "g")
             .where((F.col("position") >= F.col("base")) & (F.col("position") < F.col("base") + F.col("n_tokens")))
             .groupBy("shard", F.floor((F.col("position") - F.col("base")) / _ASKED).alias("part"))
             .agg(F.collect_set(F.col("position")).alias("positions")))
    return shard_of.select("shard", "base", "image").join(asked, "shard").select(
        "base", "image", "positions").mapInArrow(_access, "position long, token long")


#: Positions in a bucket of the position-to-shard join, and positions of a shard that one
#: row asks for at most.
_SPAN, _ASKED = 1 << 22, 1 << 16


def _access(batches):
    for b in batches:
        for base, image, positions in zip(*(b.column(i) for i in range(3))):
            w, base, at = WaveletMatrix.from_bytes(image.as_py()), base.as_py(), positions.as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array([w.access(p - base) for p in at], pa.int64())],
                ["position", "token"])


def occurrences(shards: DataFrame, ids: list[int]) -> DataFrame:
    """(token, n, first): how often each of ``ids`` occurs in all shards, and the global
    position of its first occurrence (null without one), by count and select."""
    def run(batches):
        for b in batches:
            for base, image in zip(b.column(0).to_pylist(), b.column(1)):
                w = WaveletMatrix.from_bytes(image.as_py())
                n = [w.count(i) for i in ids]
                first = [base + w.select(i, 0) if k else None for i, k in zip(ids, n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(first, pa.int64())],
                    ["token", "n", "first"])

    rows = shards.select("shard", "image").join(starts(shards), "shard").select("base", "image")
    return rows.mapInArrow(run, "token long, n long, first long").groupBy("token").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"))
