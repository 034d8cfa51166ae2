"""The pipeline on a small corpus, against plain Python."""

import random
import zlib

import numpy as np
from llm.test_jaccard import brute

import corpus_pipeline
from stratus.llm import mixing
from stratus.llm.queries import END_ID, tokenizer_path


def _tables(spark, path):
    rng = random.Random(12)
    word = lambda: "w%d" % int(rng.paretovariate(0.4))
    items = [(k, " ".join("b%d" % rng.randrange(400) for _ in range(30))) for k in range(5)]
    docs, labels = [], []
    for i in range(240):
        w = [word() for _ in range(rng.randrange(20, 120))]
        kind = i % 12
        if kind == 0:
            w[3:3] = ["vilest", "nastyword"]
        elif kind == 1 and i > 1:
            w = docs[i - 12][1].split() + ["tail%d" % i] * (i % 3)  # copies and near copies
        elif kind == 2:
            w[5:5] = items[i % 5][1].split()
        docs.append((i, " ".join(w), "en", "s%d" % (i % 3), len(w)))
        labels.append((i, 1, int(kind == 0)))
    docs += [(900, None, "en", None, 0), (901, "", "en", "s1", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return {d[0]: d for d in docs}


def test_pipeline_matches_plain_python(spark, tmp):
    from tokenizers import Tokenizer

    docs = _tables(spark, tmp)
    at = spark.read.parquet(f"{tmp}/documents.parquet")
    kept, frames = [], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, tmp)
        assert out.columns == at.columns
        out.write.parquet(f"{tmp}/{name}")
        at = spark.read.parquet(f"{tmp}/{name}")
        frames.append(at)
        kept.append({r["doc_id"] for r in at.select("doc_id").collect()})
    toxic = {i for i in docs if i < 900 and i % 12 == 0}
    assert len(toxic & kept[0]) <= 2 and len((set(docs) - toxic) - kept[0]) <= 2
    first = brute([(i, docs[i][1]) for i in kept[0]])
    assert kept[1] == {i for i, (_, c) in first.items() if c == i}
    leaked = {i for i in kept[1] if i < 900 and i % 12 == 2}
    assert kept[2] == kept[1] - leaked
    left = [docs[i] for i in sorted(kept[2])]
    size, total = {}, 0
    for d in left:
        size[d[3]] = size.get(d[3], 0) + len((d[1] or "").split())
    total = sum(size.values())
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        free = sum(w for s, w in weight.items() if s not in capped)
        level = (total - 3 * sum(size[s] for s in capped)) / free
        more = {s for s in size if level * weight[s] > 3 * size[s]}
        if more == capped:
            break
        capped = more
    mixed = {}
    for r in frames[3].select("doc_id").collect():
        mixed[r["doc_id"]] = mixed.get(r["doc_id"], 0) + 1
    import hashlib
    for d in left:
        rate = min(level * weight[d[3]], 3 * size[d[3]]) / size[d[3]] if size[d[3]] else 0
        u = int(hashlib.md5(f"{mixing.SEED}:{d[0]}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert mixed.get(d[0], 0) == int(rate) + (u < rate - int(rate)), d[0]
    tok = Tokenizer.from_file(tokenizer_path())
    got = sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, at, tmp).collect()), key=lambda r: r[1])
    start = 0
    assert sorted(r[0] for r in got) == sorted(i for i, n in mixed.items() for _ in range(n))
    for doc, begin, n, crc in got:
        ids = tok.encode(docs[doc][1] or "", add_special_tokens=False).ids + [END_ID]
        assert (begin, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
