"""Target-distribution resampling against a plain Python version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratus.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, max_n=2):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, buckets=10000, max_n=2, seed=7, min_words=20, percent=25):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for _, x in side for g in grams(x, max_n)[1]) for side in (rows, target))
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        w, gs = grams(text, max_n)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                for b in map(bucket, gs)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(w)])
    able = sorted((r for r in out if r[4] >= min_words),
                  key=lambda r: (-r[3], -1 if r[0] is None else r[0], -r[2], r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((tuple(map(str, (*r[:4], rank.get(id(r))))) for r in out))


def found(df):
    return sorted(tuple(map(str, r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_crc_of_any_part_from_two_prefixes():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 70_000, dtype=np.uint8)
    run = resample.RunningCrc(data)
    lo = np.concatenate((rng.integers(0, 70_000, 300), [0, 0, 70_000]))
    hi = np.concatenate((lo[:300] + rng.integers(0, 70_001 - lo[:300]), [70_000, 0, 70_000]))
    assert run.crc32(lo, hi).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(lo, hi)]


@pytest.mark.parametrize("piece", [48, 1000, 1 << 20])
@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_features_of_whole_texts(piece, max_n, monkeypatch):
    monkeypatch.setattr(resample, "PIECE", piece)
    rnd = random.Random(piece)
    texts = [None, "", " ", "...", "a", "Ab cé", "..x..y", "w" * 300, "KſK ÉA Z"] + [
        "".join(rnd.choice("abZ é1. -漢\n") for _ in range(rnd.randint(0, 900))) for _ in range(60)]
    got, at = {}, 0
    for crc, row, count in resample.features(pa.array(texts), max_n):
        for i, c in enumerate(count):
            words, crcs = got.setdefault(at + i, [0, []])
            got[at + i][0] = words + (c if c >= 0 else -1 - c)
            crcs += crc[row == i].tolist()
        at += 0 if len(count) == 1 and count[0] < 0 else len(count)
    for i, text in enumerate(texts):
        w, gs = grams(text, max_n)
        assert got[i][0] == len(w)
        assert sorted(got[i][1]) == sorted(zlib.crc32(g.encode()) for g in gs)


def corpus(n=120):
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "épsilon", "z9", "the", "of"]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(n)]
    rows += [(500, None), (501, ""), (502, "--- ..."), (503, "alpha " * 30_000),
             (None, "null id " * 15), (7, rows[7][1]), (7, "another text under id seven " * 9)]
    return rows, [(0, "alpha beta of the alpha"), (1, None), (2, "z9 z9")]


def test_equals_brute_force(spark, docs, scratch):
    rows, target = corpus()
    got = resample.ranked(resample.scores(docs(rows, extra=True), docs(target), scratch))
    assert found(got) == brute(rows, target)


def test_other_parameters(spark, docs, scratch):
    rows, target = corpus(60)
    got = resample.ranked(resample.scores(docs(rows), docs(target), scratch, buckets=97, max_n=3, seed=11),
                          min_words=5, percent=60)
    assert found(got) == brute(rows, target, 97, 3, 11, 5, 60)


def test_empty_tables(spark, docs, scratch):
    rows, _ = corpus(40)
    got = resample.ranked(resample.scores(docs(rows), docs([]), scratch))
    assert found(got) == brute(rows, [])
    assert resample.ranked(resample.scores(docs([]), docs(rows), scratch)).count() == 0


def test_drawn_documents_lean_towards_the_target(spark, docs, scratch):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices(["near", "nigh", "by"] if i % 4 == 0 else ["far", "off", "away"], k=40)), f"s{i}")
            for i in range(200)]
    drawn = resample.resample(docs(rows, extra=True), docs([(0, "near nigh by " * 50)]), scratch)
    assert drawn.columns == docs(rows, extra=True).columns
    got = {(r.doc_id, r.text, r.source) for r in drawn.collect()}
    assert got <= set(rows) and len(got) == 50
    assert sum(1 for r in got if r[0] % 4 == 0) >= 35  # 12 or 13 by chance
