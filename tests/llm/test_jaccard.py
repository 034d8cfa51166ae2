import random
import re
from fractions import Fraction

import numpy as np
import pytest

from stratus.llm import jaccard as J

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = _WORD.findall((text or "").lower())
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """doc_id -> (size, component) from all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def texts(seed, n, lengths, common):
    """Random texts, edits of earlier ones, and texts around a common passage."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.5:
            w = rng.choice(out).split()
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                k = rng.randrange(len(w))
                w[k: k + rng.randrange(2)] = [word()] * rng.randrange(2)
        elif kind < 0.7:
            w = common + [word() for _ in range(rng.randrange(0, 10))]
        else:
            w = [word() for _ in range(rng.choice(lengths))]
        out.append(" ".join(w) or "one")
    return list(enumerate(out))


def run(df, scratch):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.near_duplicates(df, scratch).collect()}


@pytest.mark.parametrize("hot", [64, 3])
@pytest.mark.parametrize("lengths", [[1, 3, 5, 6, 8, 9, 11, 13], [20, 40, 80, 150]])
def test_matches_brute_force(docs, scratch, monkeypatch, lengths, hot):
    monkeypatch.setattr(J, "HOT", hot)  # at 3, nearly every shared signature is hot
    rows = texts(len(lengths) * 10 + hot, 220, lengths, ["c%d" % i for i in range(14)])
    assert run(docs(rows), scratch) == brute(rows)


def test_edge_cases(docs, scratch):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Same text here"), (5, "same  TEXT here"), (6, "a b c d e f g"),
            (7, "a b c d e f g"), (8, "word " * 3000), (9, "word " * 2000)]
    got = run(docs(rows, extra=True), scratch)
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (3, 6), 7: (3, 6), 8: (1, 8), 9: (1, 8)}


def test_repeated_rows_and_empty_table(docs, scratch):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, "x y z")]
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in J.near_duplicates(docs(rows), scratch).collect())
    assert got == [(-1, -1), (5, 5), (5, 5), (9, 9)]
    assert J.near_duplicates(docs([]), scratch).count() == 0


@pytest.mark.parametrize("many", [1, 10 ** 9])
def test_similar_sets_always_share_a_signature(many):
    """Pairs at the very limit, in bands of either allocation."""
    t = Fraction(3, 4)
    rng = np.random.default_rng(4)
    lows = dict(J.edges_of_bands(t, 400))
    bands = J.allocate({lo: many for lo in lows}, t)
    assert {b.deletions for b in J.allocate({lo: 10 ** 9 for lo in lows}, t)} == {True, False}
    def band_of(n):
        return max(k for k, b in enumerate(bands) if b.lo <= n)
    for _ in range(3000):
        a = rng.integers(0, 2 ** 63, int(rng.integers(1, 40)), dtype=np.uint64) * np.uint64(2)
        drop = int(rng.integers(0, len(a) + 1))
        b = np.concatenate((a[drop:], rng.integers(0, 2 ** 63, int(rng.integers(0, 9)), dtype=np.uint64)))
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if not len(b) or 4 * both < 3 * (len(a) + len(b) - both):
            continue
        sigs = []
        for u in (a, b):
            k = band_of(len(u))
            own = [k] + ([k + 1] if k + 1 < len(bands) and int(len(u) / t) >= bands[k + 1].lo else [])
            sigs.append({int(s) for j in own for s in J.signatures(u, j, bands[j], t)[0]})
        assert sigs[0] & sigs[1]


def common_phrase(n, own=3):
    rng = random.Random(own)
    return [(i, "one two three four five six seven " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(own)))
            for i in range(n)]


def test_short_texts_around_one_phrase(docs, scratch, monkeypatch):
    """All share a hot signature that none can skip; a few are near copies."""
    rows = common_phrase(400) + [(500 + i, t) for i, t in common_phrase(60, 1)] + [(1000, "one two three four five six seven")]
    rows += [(2000 + i, rows[i][1] + " tail") for i in range(0, 40, 3)]
    assert run(docs(rows), scratch) == brute(rows)
