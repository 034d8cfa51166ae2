"""Secrets in texts: fixed patterns, and a guess cost for values in credential contexts.

Patterns (spans of whole matches, leftmost and not overlapping per kind):
``assign`` (a credential word, a separator and a value of 6 or more characters),
``access`` (AKIA and 16 or more upper-case letters or digits) and ``hex`` (24 or
more hexadecimal digits).

The method looks at values after credential words in a wider sense (quoted or
not, any characters but white space, also behind ``is``, ``=>``, ``Bearer`` and in
``://user:value@``) and asks how many guesses an attacker needs.  A value is cut
into words, dates, repeats, keyboard walks and brute-force spans so that the sum
of their costs (bits) is least, by dynamic programming over its positions; it is
a secret if that is :data:`SECRET_BITS` or more.  So ``hunter2``, ``aaaaaaaa``,
``qwertyuiop``, ``12.03.2019`` and words of the corpus in a row are left alone.

The words are the corpus's own: the value's runs of 3 to 24 ASCII letters (as they
stand and with common digit and sign substitutions undone) are looked up, by an
equi-join, in the counts of all words of all texts; a word seen :data:`MIN_COUNT`
times or more costs log2(all words / its count).  No dictionary is broadcast or
cut.

Edge cases: null and empty texts have no spans.  Texts and values of any length
are scanned whole (the program is linear in a value's length, bar repeats of
units up to 12 characters).  Repeated rows are judged one by one.  An empty table
gives no rows.  Positions count code points, ends exclusive.  Other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.scratch import Scratch
from stratus.llm.words import BYTE_VALUE, mix, powers, text_buffers

#: Guesses (in bits) from which a value is a secret: ten thousand million.
SECRET_BITS = math.log2(1e10)
#: Occurrences from which a run of letters is a word of the dictionary.
MIN_COUNT = 5
WORD_MIN, WORD_MAX = 3, 24

# The kinds, in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "guess"]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
_HEX = re.compile("[0-9a-f]{24,}")
_CREDENTIAL = (r"pass(?:word|wd|phrase|code|key)?|pwd|secret|token|credentials?|bearer|"
               r"(?:api|access|private|secret|encryption|account)[_\-\x20]?key|auth[_\-]?(?:key|token)?")
_CONTEXT = re.compile(
    rf"""(?<![A-Za-z])(?:{_CREDENTIAL})["'\]]?(?:\x20*(?::=|=>|->|[:=])\x20*|\x20+is:?\x20+|(?<=bearer)\x20+)["'`]?"""
    r"""([^\s"'`<>]{6,})""", re.A | re.I)
_IN_URL = re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@")
_TAIL = ".,;:)]}"
# RE2 forms of what any of the patterns needs, to pass over other texts quickly.
_NEEDED = (r"(?i:pass|pwd|secret|token|credential|bearer|[ _-]key|(?:api|access|private|encryption|account)key|auth)"
           r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|://[^\s/:@]+:")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in order of start, then kind."""
    out = [(*m.span(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(*m.span(), 1) for m in _ACCESS.finditer(text)]
    out += [(*m.span(), 2) for m in _HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2]))]


def context_values(text: str) -> list[tuple[int, int]]:
    """Spans of values in credential contexts, in order, each once."""
    found = set()
    for pattern in (_CONTEXT, _IN_URL):
        for m in pattern.finditer(text):
            value = m[1].rstrip(_TAIL) if pattern is _CONTEXT else m[1]
            if len(value) >= 6:
                found.add((m.start(1), m.start(1) + len(value)))
    return sorted(found)


# --- guess cost --------------------------------------------------------------
# Keyboard rows, unshifted and shifted, and the shift of each row
# in half keys to the right.
_ROWS = [("`1234567890-=", "~!@#$%^&*()_+", 0), ("qwertyuiop[]\\", "QWERTYUIOP{}|", 3),
         ("asdfghjkl;'", "ASDFGHJKL:\"", 4), ("zxcvbnm,./", "ZXCVBNM<>?", 5)]
_KEY = {c: (2 * i + shift, y) for y, (low, high, shift) in enumerate(_ROWS)
        for row in (low, high) for i, c in enumerate(row)}
# Signs that stand for letters.
_SIGNS = str.maketrans("430157$@!+", "aeoistsait")
_LETTER_BITS = math.log2(26)
_CLASS_BITS = [(str.isdigit, math.log2(10)), (str.islower, _LETTER_BITS), (str.isupper, _LETTER_BITS)]
_OTHER_BITS, _FAR_BITS = math.log2(33), 7.0
#: Bits for starting any further part of a value.
PART_BITS = 1.0
_WALK_START, _WALK_TURN, _WALK_ON, _WALK_SHIFT = math.log2(47), 3.0, 0.5, 1.0
_YEAR_NOW, _YEAR_SPAN = 2020, 20
_UNIT_MAX = 12
_DATE = re.compile(r"(?=(\d{1,4})([-/._ ]?)(\d{1,2})\2(\d{1,4}))", re.A)
_YEAR = re.compile(r"(?=(?:19|20)\d\d)", re.A)


def char_bits(c: str) -> float:
    if not c.isascii():
        return _FAR_BITS
    return next((bits for fits, bits in _CLASS_BITS if fits(c)), _OTHER_BITS)


def case_bits(word: str) -> float:
    """Cost of a word's capitals: none, the first or all are the usual forms."""
    n = len(word)
    up = sum(c.isupper() for c in word)
    if up == 0:
        return 0.0
    if up == n or (up == 1 and (word[0].isupper() or word[-1].isupper())):
        return 1.0
    return math.log2(sum(math.comb(n, k) for k in range(1, min(up, n - up) + 1)) + 1)


def _year_bits(year: int) -> float:
    return math.log2(max(abs(year - _YEAR_NOW), _YEAR_SPAN))


def _full_year(digits: str) -> int | None:
    if len(digits) == 4:
        return int(digits) if 1900 <= int(digits) <= 2099 else None
    return (1900 if int(digits) > 50 else 2000) + int(digits) if len(digits) == 2 else None


def dates(value: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, bits) of years and of dates with or without separators."""
    for m in _YEAR.finditer(value):
        yield m.start(), m.start() + 4, _year_bits(int(value[m.start(): m.start() + 4]))
    for m in _DATE.finditer(value):
        start, sep = m.start(), m[2]
        if sep:
            end = m.end(4)
            splits = [(m[1], m[3], m[4][:n]) for n in (2, 4) if len(m[4]) >= n] if len(m[1]) <= 2 else []
            splits += [(m[4][:2], m[3], m[1])] if len(m[1]) == 4 else []
        else:
            digits = re.match(r"\d+", value[start: start + 8], re.A)[0]
            splits = []
            for n in (4, 5, 6, 8):  # d m yy, dd m yy, dd mm yy, dd mm yyyy and yyyy mm dd
                part = digits[:n]
                if len(part) == n:
                    splits += {4: [(part[0], part[1], part[2:])],
                               5: [(part[:2], part[2], part[3:]), (part[0], part[1:3], part[3:])],
                               6: [(part[:2], part[2:4], part[4:]), (part[4:], part[2:4], part[:2])],
                               8: [(part[:2], part[2:4], part[4:]), (part[6:], part[4:6], part[:4])]}[n]
        for day, month, year in splits:
            y = _full_year(year)
            a, b = int(day or 0), int(month)
            if y is not None and ((1 <= a <= 31 and 1 <= b <= 12) or (1 <= b <= 31 and 1 <= a <= 12)):
                end = start + len(day) + len(month) + len(year) + 2 * len(sep)
                yield start, end, math.log2(365) + _year_bits(y) + (2.0 if sep else 0.0)


def repeats(value: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, unit length) of maximal runs of a repeated unit."""
    n = len(value)
    for unit in range(1, min(_UNIT_MAX, n // 2) + 1):
        run = 0
        for i in range(unit, n + 1):
            if i < n and value[i] == value[i - unit]:
                run += 1
                continue
            times = run // unit + 1
            if times >= (3 if unit == 1 else 2):
                yield i - unit - run, i - unit - run + times * unit, unit
            run = 0


def _step(a: str, b: str) -> tuple[int, int] | None:
    """The direction from one key to a neighbour, or to the next letter or digit of
    the alphabet up or down; else None."""
    if a.isascii() and a.isalnum() and b.isascii() and b.isalnum() and abs(ord(a) - ord(b)) == 1:
        return 0, 100 * (ord(b) - ord(a))
    if a not in _KEY or b not in _KEY:
        return None
    (x, y), (u, v) = _KEY[a], _KEY[b]
    move = u - x, v - y
    return move if move[1] in (-1, 0, 1) and abs(move[0]) <= (2 if move[1] == 0 else 3) and move != (0, 0) else None


def guess_bits(value: str, words: list[tuple[int, int, float]]) -> float:
    """Bits of the cheapest cut of ``value``; ``words`` are (start, end, bits) of the
    dictionary words in it."""
    n = len(value)
    parts: dict[int, list[tuple[int, float]]] = {}
    for a, b, bits in words:
        parts.setdefault(b, []).append((a, bits + case_bits(value[a:b])))
    for a, b, bits in dates(value):
        parts.setdefault(b, []).append((a, bits))
    for a, b, unit in repeats(value):
        inner = [(s - a, e - a, c) for s, e, c in words if a <= s and e <= a + unit]
        parts.setdefault(b, []).append((a, guess_bits(value[a: a + unit], inner) + math.log2((b - a) // unit)))
    best, force = 0.0, math.inf
    at = [0.0]  # best cost up to each position
    walk = pair = math.inf  # ending here in a walk of three keys or more, of two
    came = None
    for j in range(1, n + 1):
        c = value[j - 1]
        force = min(at[j - 1] + PART_BITS, force) + char_bits(c)
        move = _step(value[j - 2], c) if j > 1 else None
        shift = _WALK_SHIFT if c in _KEY and c in _ROWS[_KEY[c][1]][1] else 0.0
        on = (_WALK_ON if move == came else _WALK_TURN) + shift
        walk = min(walk, pair) + on if move and came else math.inf
        pair = at[j - 2] + PART_BITS + _WALK_START + _WALK_TURN + shift if move else math.inf
        came = move
        best = min(force, walk, *(at[a] + PART_BITS + bits for a, bits in parts.get(j, ())))
        at.append(best)
    return at[n]


# --- words in values -----------------------------------------------------------
def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers to hash any part of ``data``: mix((sum[b] -
    sum[a]) * down[a])."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=total[1:])
    return total, down, up


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def letter_runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ASCII letters."""
    edge = np.diff(np.concatenate(([False], _LETTER[data], [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: Bytes hashed at once.
_PIECE = 1 << 17


def word_hashes(data: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of a text's words: maximal runs of WORD_MIN to WORD_MAX letters."""
    at = 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and _LETTER[data[end - 1]]:  # not inside a run
            stop = min(end + _PIECE, len(data))
            gaps = np.flatnonzero(~_LETTER[data[end:stop]])
            end = end + int(gaps[0]) + 1 if len(gaps) else stop
        part = data[at:end]
        lo, hi = letter_runs(part)
        fits = (hi - lo >= WORD_MIN) & (hi - lo <= WORD_MAX)
        lo, hi = lo[fits], hi[fits]
        total, down, _ = _hashes(part)
        yield mix((total[hi] - total[lo]) * down[lo])
        at = end


def _count_words(batches):
    """Texts -> (hash, n), added up per about a million words before the shuffle."""
    held: list[np.ndarray] = []
    size = 0

    def flush():
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])

    for b in batches:
        texts = list(text_buffers(b.column(0)))
        joined: list[np.ndarray] = []
        space = np.full(1, 0x20, np.uint8)
        for t in texts:
            joined += [t, space]
        for h in word_hashes(np.concatenate(joined)) if joined else ():
            held.append(h)
            size += len(h)
        if size > 1 << 21:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def parts_of(value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, signs undone, hash) of all runs of letters in ``value`` that a word
    may be, as it stands and with signs read as letters."""
    plain = value.encode("ascii", "replace")
    signs = value.translate(_SIGNS).encode("ascii", "replace")
    known, out = None, []
    for raw in (plain, signs) if signs != plain else (plain,):
        data = np.frombuffer(raw, np.uint8)
        total, down, _ = _hashes(data)
        # Letters from each position on.
        run = np.zeros(len(data) + 1, np.int64)
        stop = np.flatnonzero(~_LETTER[data])
        ends = np.concatenate((stop, [len(data)]))
        run[:-1] = ends[np.searchsorted(stop, np.arange(len(data)))] - np.arange(len(data))
        changed = np.concatenate(([0], np.cumsum(data != np.frombuffer(plain, np.uint8))))
        for k in range(WORD_MIN, WORD_MAX + 1):
            lo = np.flatnonzero(run >= k)
            n_signs = changed[lo + k] - changed[lo]
            if known is not None:
                lo, n_signs = lo[n_signs > 0], n_signs[n_signs > 0]
            if len(lo):
                out.append((lo, lo + k, n_signs, mix((total[lo + k] - total[lo]) * down[lo])))
        known = raw
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


# --- Spark ---------------------------------------------------------------------
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
_VALUE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])


def _scan(batches):
    """(doc_id, text) -> (doc_id, spans, values): fixed patterns and context values."""
    for b in batches:
        texts = pc.fill_null(b.column(1), "")
        rows = np.flatnonzero(pc.match_substring_regex(texts, _NEEDED).to_numpy(zero_copy_only=False))
        spans: list[list] = [[] for _ in range(b.num_rows)]
        values: list[list] = [[] for _ in range(b.num_rows)]
        for r in rows:
            text = texts[int(r)].as_py()
            spans[r] = [dict(zip(("start", "end", "kind"), s)) for s in base_spans(text)]
            values[r] = [{"start": a, "end": e, "value": text[a:e]} for a, e in context_values(text)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(spans, pa.list_(_SPAN)), pa.array(values, pa.list_(_VALUE))],
            ["doc_id", "spans", "values"])


def _parts(batches):
    """(value_id, value) -> (value_id, start, end, signs, hash)."""
    for b in batches:
        for i, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, e, signs, h = parts_of(value)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), i)), pa.array(a), pa.array(e), pa.array(signs),
                     pa.array(h.view(np.int64))], ["value_id", "start", "end", "signs", "hash"])


def _cost(batches):
    """(value_id, value, words) -> (value_id, bits)."""
    for b in batches:
        out = []
        for value, words in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            out.append(guess_bits(value, [(w["start"], w["end"], w["bits"]) for w in words or ()]))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["value_id", "bits"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(hash, n): occurrences of every word of all texts."""
    return (docs.select(F.col("text").cast("string")).mapInArrow(_count_words, "hash long, n long")
            .groupBy("hash").agg(F.sum("n").alias("n")))


def value_bits(values: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(value, bits) of every distinct value: words looked up in the counts of all
    texts, then the cheapest cut."""
    distinct = scratch.save(values.select("value").distinct().select(
        F.monotonically_increasing_id().alias("value_id"), "value"), "values")
    parts = distinct.mapInArrow(_parts, "value_id long, start long, end long, signs long, hash long")
    counts = scratch.save(word_counts(docs), "words")
    total = counts.agg(F.sum("n")).first()[0] or 1
    bits = F.log2(F.lit(float(total)) / F.col("n")) + F.col("signs")
    words = (parts.join(counts.where(F.col("n") >= MIN_COUNT), "hash")
             .groupBy("value_id").agg(F.collect_list(F.struct("start", "end", bits.alias("bits"))).alias("words")))
    costs = distinct.join(words, "value_id", "left").select("value_id", "value", "words").mapInArrow(
        _cost, "value_id long, bits double")
    return distinct.join(costs, "value_id").select("value", "bits")


def findings(docs: DataFrame, scratch: Scratch, secret_bits: float = SECRET_BITS) -> DataFrame:
    """(doc_id, spans) per row of ``docs``: the spans (start, end, kind) of all
    secrets, by start, then kind.  ``guess`` spans are the context values of
    ``secret_bits`` or more that no span of a fixed pattern holds."""
    found = scratch.save(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_scan, "doc_id long, spans array<struct<start:long,end:long,kind:string>>, "
                           "values array<struct<start:long,end:long,value:string>>")
        .withColumn("row", F.monotonically_increasing_id()), "found")
    values = found.select("row", "spans", F.explode("values").alias("v")).select("row", "spans", "v.*")
    open_values = values.where(~F.exists("spans", lambda s: (s["start"] <= F.col("start")) & (s["end"] >= F.col("end"))))
    open_values = scratch.save(open_values.drop("spans"), "open")
    strong = value_bits(open_values, docs, scratch).where(F.col("bits") >= secret_bits).select("value")
    more = (open_values.join(strong, "value").groupBy("row").agg(
        F.collect_list(F.struct("start", "end", F.lit("guess").alias("kind"))).alias("more")))
    kinds = F.array(*map(F.lit, KINDS))
    keyed = F.transform(F.concat("spans", F.coalesce("more", F.array().cast(
        "array<struct<start:bigint,end:bigint,kind:string>>"))), lambda s: F.struct(
            s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("place"), s["end"].alias("end"),
            s["kind"].alias("kind")))
    in_order = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    return found.join(more, "row", "left").select("doc_id", in_order.alias("spans"))


def joined(spans: Column, fixed_only: bool = False) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"] != "guess") if fixed_only else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
