"""Toxicity scores and benchmark search against plain Python."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import decontaminate, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
M32 = (1 << 32) - 1


def plain_score(text, model):
    """Every n-gram of every word by itself: bags averaged into words, words into
    passages, the worst passage through the softmax."""
    def number(gram, k):
        h = sum(ord(c) * int(m) for c, m in zip(gram, toxicity._MULT)) & M32
        h = ((h ^ (h >> 15)) * int(toxicity._SPIN[k])) & M32
        return float(model.table[h >> 15])

    values = []
    for w in WORDS.findall((text or "").translate(LOWER)):
        padded = f" {w} "
        grams = [(padded[i:i + 3 + k], k) for k in range(3) for i in range(len(padded) - 2 - k)]
        values.append(sum(number(g, k) for g, k in grams) / len(grams))
    n, size = len(values), toxicity.PASSAGE
    starts = [0] if n <= size else sorted({*range(0, n - size + 1, size // 2), n - size})
    worst = max(sum(values[s:s + size]) / len(values[s:s + size]) for s in starts) if n else 0.0
    return 1 / (1 + math.exp(-(worst + model.bias)))


def test_scores_equal_the_averaged_bags(spark, docs, monkeypatch):
    rng = random.Random(3)
    table = np.random.default_rng(4).normal(0, 4, toxicity.BUCKETS).astype(np.float32)
    model = toxicity.Model(table, -1.25)
    texts = [None, "", " \n", "a", "Ab cé", "one two three four five", "x" * 300] + [
        " ".join("".join(rng.choice("abCdé漢1.") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 80)))
        for _ in range(60)]
    got = docs(list(enumerate(texts))).select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
    for r in got:
        assert r["s"] == pytest.approx(plain_score(texts[r["doc_id"]], model), abs=1e-6), texts[r["doc_id"]]
    monkeypatch.setattr(toxicity, "CHUNK", 40)  # long texts in many pieces
    for t in texts[5:30]:
        raw = np.frombuffer(t.encode(), np.uint8)
        assert model.score(raw) == pytest.approx(plain_score(t, model), abs=1e-6)


def weighted_lcs(a, w, b):
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w[i] if x == y else 0.0)
    return best[-1][-1] / sum(w)


def test_leaks_against_an_exhaustive_search(spark, docs, scratch):
    """All pairs of documents and items by plain dynamic programming over the whole
    document: nothing is found that it doesn't confirm, and of what stands in one
    place it confirms, nine in ten are found."""
    rng = random.Random(12)
    word = lambda: f"v{int(rng.paretovariate(0.35)) % 100_000}"
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate([15, 18, 20, 25, 30, 35, 40, 50])]
    rows, planted = [], set()
    for i in range(70):
        w = [word() for _ in range(rng.randrange(5, 160))]
        if i % 3 == 0:
            k, at = rng.randrange(len(items)), rng.randrange(len(w) + 1)
            copy = list(items[k][1])
            if i % 2:  # a paraphrase: every fifth word
                copy[::5] = [word() for _ in copy[::5]]
            w[at:at] = copy
            planted.add((i, k))
        rows.append((i, w))
    passages = sum(-(-len(w) // 32) for _, w in rows)
    count = {}
    for _, w in rows:
        for x in w:
            count[x] = count.get(x, 0) + 1
    weight = lambda x: math.log1p((1 + passages) / (1 + count.get(x, 0)))
    true = set()
    for d, w in rows:
        for k, item in items:
            if len(set(item) & set(w)) < 0.3 * len(set(item)):
                continue
            v = [weight(x) for x in item]
            share = weighted_lcs(item, v, w)
            if share >= decontaminate.STRONG or share >= decontaminate.WEAK and weighted_lcs(
                    item[-8:], v[-8:], w) >= decontaminate.ANSWER:
                true.add((d, k))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    found = decontaminate.leaks(docs([(d, " ".join(w)) for d, w in rows]), bench, scratch)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got <= true
    assert len(got & planted & true) >= 0.9 * len(planted & true) > 10
