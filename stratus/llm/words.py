"""Word hashing over Arrow text columns, in numpy.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D),
with A-Z lower-cased; as no byte of a multi-byte UTF-8 character is ASCII, this
is the same as the regular expression over characters.  Every word becomes a
64-bit hash: the polynomial sum of random byte values, computed for a whole
buffer with one prefix sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; a longer single word is hashed in one piece.
PIECE = 1 << 17

_rng = np.random.default_rng(20240607)
BYTE_VALUE = _rng.integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]  # A-Z count as a-z
_power: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, grown on demand."""
    if not _power or len(_power["up"]) < n:
        size = max(n, PIECE + 1)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _power[key] = np.multiply.accumulate(steps)
    return _power["up"], _power["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def is_space(b: np.ndarray) -> np.ndarray:
    """0x20 or 0x09 to 0x0D."""
    return (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))


def _piece(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the words of one byte buffer."""
    edge = np.diff(np.concatenate(([True], is_space(b), [True])).view(np.int8))
    starts = np.flatnonzero(edge == -1)
    ends = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    up, down = powers(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(np.take(BYTE_VALUE, b, mode="clip") * up[: len(b)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts, ends


def hash_words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the words of a byte buffer of any length."""
    if len(b) <= PIECE:
        return _piece(b)
    out, at = [], 0
    while at < len(b):
        end = min(at + PIECE, len(b))
        if end < len(b):
            gaps = np.flatnonzero(is_space(b[at:end]))
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word fills the piece: go on to its end
                later = np.flatnonzero(is_space(b[end:]))
                end = end + int(later[0]) if len(later) else len(b)
        h, s, e = _piece(b[at:end])
        out.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out))


def text_buffers(col: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each row; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        for c in col.chunks:
            yield from text_buffers(c)
        return
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, wide)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    nulls = np.asarray(col.is_null()) if col.null_count else None
    for i in range(len(col)):
        yield raw[:0] if nulls is not None and nulls[i] else raw[off[i]: off[i + 1]]


def doc_words(col: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each row, in order.

    Short rows are hashed together (a word never spans two rows, as a space is
    put between them), long ones alone and in pieces.
    """
    held: list[np.ndarray] = []
    size = 0
    gap = np.full(1, 0x20, np.uint8)

    def flush() -> Iterator[np.ndarray]:
        if not held:
            return
        if len(held) == 1:
            yield hash_words(held[0])[0]
            return
        parts = [x for b in held for x in (b, gap)]
        bounds = np.cumsum([len(b) + 1 for b in held])
        h, s, _ = hash_words(np.concatenate(parts))
        cut = np.searchsorted(s, bounds)
        lo = 0
        for hi in cut:
            yield h[lo:hi]
            lo = hi

    for b in text_buffers(col):
        if size + len(b) > PIECE and held:
            yield from flush()
            held, size = [], 0
        held.append(b)
        size += len(b) + 1
    yield from flush()


#: Multipliers of the five words of a shingle, in order.
_SHINGLE = _rng.integers(1, _MASK, 5, dtype=np.uint64, endpoint=True) | np.uint64(1)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of all runs of ``k`` words; with fewer words, of the whole text as
    one; without words, none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        seed = np.uint64(n * 0x632BE59BD9B4E019 & _MASK)
        return mix(np.array([np.sum(words * _SHINGLE[:n], dtype=np.uint64)]) ^ seed)
    total = words[: n - k + 1] * _SHINGLE[0]
    for j in range(1, k):
        total = total + words[j: n - k + 1 + j] * _SHINGLE[j]
    return mix(total)
