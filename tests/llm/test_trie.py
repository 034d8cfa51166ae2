"""Prefix trie of conversations against a plain Python version."""

import hashlib
import random
import zlib

import pytest

from stratus.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows, every=5, most=9):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(abs(c) % every) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(seqs):
    """{(depth, smallest member): row} by listing every prefix."""
    members = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for p, ms in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaf = [q for q in below if not any(len(x) == len(q) + 1 and x[:-1] == q for x in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in ms if len(seqs[c]) == len(p))))
        rows.append((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), len(kids), len(leaf), saved,
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, rows))


def found(df):
    assert df.columns == COLUMNS
    return sorted(str(tuple(r)) for r in df.collect())


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", *(f"'x' AS {c}" for c in ("ids", "sizes", "key", "shard", "size", "id", "n", "place",
                                                        "depth", "_base"))) if extra else df


def conversations(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in range(-12, n):
        if rnd.random() < 0.8:
            for turn in range(rnd.choice([1, 2, 3, 9, 14])):
                rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bé", "", None, "ccc"])))
    same = [(0, "user", "hello"), (1, "assistant", "hi"), (2, "user", "more")]
    rows += [(c, *t) for c in range(1000, 1060) for t in same]
    rows += [(2000, t, "user", f"turn {t % 3}") for t in range(170)]
    rows += [(None, 0, "user", "nobody"), (7, None, "user", "first"), (8, 1, "user", "tie"), (8, 1, "assistant", "tie"),
             (9, 0, "user", "a"), (9, 0, "user", "a")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [20, 300, 1_000_000])
def test_equals_brute_force(spark, scratch, shard_turns):
    rows = [r for r in conversations(shard_turns) if r[0] != 2000]
    seqs = trie.regrafted(trie.encoded(table(spark, rows, extra=True), scratch))
    assert found(trie.prefix_trie(seqs, scratch, shard_turns)) == brute(rebuilt(rows))


def test_a_long_conversation(spark, scratch):
    rows = [r for r in conversations(4) if r[0] in (2000, 2001, 1000, 1001)]
    rows += [(2001, t, "user", f"turn {t % 3}") for t in range(150)]
    seqs = trie.regrafted(trie.encoded(table(spark, rows), scratch))
    assert found(trie.prefix_trie(seqs, scratch, 40)) == brute(rebuilt(rows))


def test_hot_conversation_over_many_shards(spark, scratch):
    rows = [(c, t, "user", x) for c in range(0, 2000, 5) for t, x in enumerate(["one", "two"])]
    rows += [(5 * c, 2, "user", f"end {c}") for c in range(0, 400, 7)]
    seqs = trie.encoded(table(spark, rows), scratch)
    own = {}
    for c, t, r, x in sorted(rows):
        own.setdefault(c, []).append((r, x))
    assert found(trie.prefix_trie(seqs, scratch, 50)) == brute(own)


def test_no_rows(spark, scratch):
    seqs = trie.regrafted(trie.encoded(table(spark, []), scratch))
    assert found(trie.prefix_trie(seqs, scratch)) == []
    only_null = trie.regrafted(trie.encoded(table(spark, [(None, 0, "a", "b")]), scratch))
    assert found(trie.prefix_trie(only_null, scratch)) == []


def test_tree_finds_what_it_holds():
    rnd = random.Random(2)
    seqs = sorted({tuple(rnd.choices(range(-4, 5), k=rnd.randint(0, 6))) for _ in range(200)})
    assert sorted(trie.median_order(len(seqs))) == list(range(len(seqs)))
    tree = trie.TernaryTree()
    paths = {seqs[i]: tree.insert(list(seqs[i])) for i in trie.median_order(len(seqs))}
    size = len(tree.key)
    assert size == len({s[:d] for s in seqs for d in range(len(s) + 1)})
    for s in seqs:
        assert tree.insert(list(s)) == paths[s] and len(tree.key) == size
        assert [tree.key[n] for n in paths[s][1:]] == list(s)
