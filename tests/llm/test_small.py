"""URL rules, mixing, chat formatting, toxicity, wavelet shards on small tables."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stratus.llm import chat, mixing, toxicity, urls, wavelet
from stratus.llm.queries import END_ID, URL_RULES, tokenizer_path


# --- URL rules -------------------------------------------------------------
def _judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fits)[3], max(fits)[4]) if fits else (None, "allow")))


def test_urls_match_brute_force(spark):
    hosts = ["a.net", "NET", "example.net", "x.Example.Net", "example.com", "notexample.com", "b.org", "net:80", ""]
    paths = ["", "/", "/en/1", "/en", "/de/2?x=/fr/", "/fr/#y", "?/en/", "#", "/foo", "/foobar"]
    given = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme/en/", "://a.net/", "x://y://z.net/"]
    rules = [*URL_RULES, ("a.net", "/foo", "allow"), ("b.org", "", "block"), ("org", "/", "allow"),
             ("a.net", "/foo", "block"), (None, "/", "block"), ("", "/", "block")]
    pages = spark.createDataFrame([(i, u, "h", "k", "v") for i, u in enumerate(given)] + [(None, given[1], "", "", "")],
                                  "page_id long, url string, html string, key string, verdict string")
    got = urls.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(given) + 1
    live = [r for r in rules if r[0]]
    for r in got:
        url = given[1] if r["page_id"] is None else given[r["page_id"]]
        assert tuple(r)[1:] == _judge(url, live), url


def test_urls_without_rules_or_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in urls.judge(pages, none).collect()] == [(1, "a", "/b", None, "allow")]
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert urls.judge(pages.limit(0), rules).count() == 0


# --- mixing ----------------------------------------------------------------
def test_targets_share_the_excess(docs, scratch):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 50 + ["b"] * 30 + ["c"] + [None] * 5)] + [(900, None, "z")]
    got = mixing.with_copies(docs(rows, extra=True).drop("_size"), scratch).collect()
    size = {}
    for r in got:
        size[r["source"]] = size.get(r["source"], 0) + r["_size"]
    target = {r["source"]: r["_target"] for r in got}
    weight = dict(zip(["a", "b", "c", "z", None], [1, 2, 3, 1, 2]))
    level = target["a"] / 1
    for s, t in target.items():
        assert t == pytest.approx(min(level * weight[s], 3 * size[s]))
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for r in got:
        rate = r["_target"] / r["_source_size"] if r["_source_size"] else 0
        assert int(rate) <= r["_copies"] <= min(3, int(rate) + 1)


def test_mix_emits_copies_and_repeats(docs, scratch):
    df = docs([(i, "some words here " * (i % 7), "s%d" % (i % 4)) for i in range(400)], extra=True).drop("_size")
    copies = {r["doc_id"]: r["_copies"] for r in mixing.with_copies(df, scratch).collect()}
    mixed = mixing.mix(df.repartition(5), scratch)
    assert mixed.columns == df.columns
    seen = {}
    for r in mixed.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}
    assert mixing.mix(df.limit(0), scratch).count() == 0


# --- chat ------------------------------------------------------------------
CONVERSATIONS = [
    (1, 0, "system", "be brief"), (1, 1, "user", r"a \h b \\l \\ </turn> ### Assistant: x ####"),
    (1, 2, "assistant", r"\### Assistant: </turn> ok \\"), (1, 3, "assistant", None), (1, 4, "user", "end"),
    (2, 0, "user", "only"), (3, None, "a: b", "</turn></turn>#"), (3, 0, None, "x"), (None, 0, "assistant", "y"),
    (4, 0, "assistant", "twice"), (4, 0, "assistant", "twice"),
]


def test_chat_round_trip(spark, scratch):
    turns = spark.createDataFrame([(*r, 0, 0) for r in CONVERSATIONS],
                                  "conv_id long, turn long, role string, text string, segment int, body int")
    segs = scratch.save(chat.segments(turns), "segs")
    exs = scratch.save(chat.examples(segs), "exs")
    got = {r["conv_id"]: r for r in chat.digests(chat.parsed(segs, exs)).collect()}
    whole = {}
    for r in segs.orderBy("conv_id", "turn_no").collect():
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["segment"]
    for conv in {r[0] for r in CONVERSATIONS}:
        mine = sorted((r for r in CONVERSATIONS if r[0] == conv),
                      key=lambda r: tuple((x is not None, x) for x in r[1:]))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert tuple(got[conv]) == (conv, len(mine), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                                    hashlib.sha256(loss.encode()).hexdigest(), len(whole[conv]))
        # Control strings occur only where the template puts them.
        assert whole[conv].count("</turn>") == len(mine) == whole[conv].count("###")
    texts = chat.example_texts(segs, exs).collect()
    assert len(texts) == 5
    for r in texts:
        assert whole[r["conv_id"]].startswith(r["text"]) and r["text"].endswith(chat.CLOSE)
        assert r["text"][r["loss_end"]:] == chat.CLOSE


def test_chat_empty(spark, scratch):
    segs = chat.segments(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat.digests(chat.parsed(segs, chat.examples(segs))).count() == 0


# --- toxicity --------------------------------------------------------------
def test_toxicity_learns_and_generalises(spark, docs):
    rng = np.random.default_rng(1)
    bad, plain = ["horrid", "vicious", "nastyish"], ["w%dx" % i for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        w = [plain[k] for k in rng.integers(0, 200, int(rng.integers(3, 300)))]
        if i % 4 == 0:
            w[int(rng.integers(len(w)))] = bad[i // 4 % 3]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    labels += [(None, 1), (7, None), (9999, 1), (0, 0)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    df = docs(rows, extra=True)
    model = toxicity.train(df, lab)
    probe = docs([(1, "w50x w60x horrrid w70x"), (2, "w53x w64x " * 5000), (3, None), (4, ""), (5, " \n"),
                  (6, "w53x " * 9000 + "Vicious"), (7, "x" * 300000)])
    got = {r[0]: r[1] for r in probe.select("doc_id", toxicity.score(probe.text, model)).collect()}
    assert got[1] > 0.5 and got[6] > 0.5 and got[2] < 0.5
    assert got[3] == got[4] == got[5] < 0.5 and 0 <= got[7] <= 1
    kept = toxicity.keep_clean(df, lab)
    assert kept.columns == df.columns
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(left & {i for i, y in labels if y}) <= 5 and len(left) >= 290


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    df = docs([(1, "a"), (2, None)])
    assert toxicity.keep_clean(df, none).count() == 2
    assert toxicity.keep_clean(df.limit(0), none).count() == 0


# --- wavelet ---------------------------------------------------------------
@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (700, 3), (513, 2), (4000, 49408), (300, 1 << 20)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    x = rng.integers(0, top, n).astype(np.uint32)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(x).to_bytes())
    assert (w.decode() == x).all()
    for i in (rng.integers(0, n, 10) if n else []):
        v = int(x[i])
        places = np.flatnonzero(x == v)
        assert w.access(int(i)) == v and w.count(v) == len(places)
        assert w.rank(v, int(i)) == (x[:i] == v).sum()
        assert [w.select(v, k) for k in (0, len(places) - 1)] == [places[0], places[-1]]
    assert w.count(top + 5) == 0


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    texts = ["The cat's 3 hats.", "Straße, ÉTÉ! e\u0301 \u00a0x\u2003y", "<|endoftext|> a<|startoftext|>b", "", "\n\t ",
             "İstanbul ΣΑΣ ﬁ don't we'll!?", "日本語 text", "a" * 500, None]
    enc = wavelet.Encoder(tokenizer_path())
    assert enc.simple
    want = Tokenizer.from_file(tokenizer_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    for got, e in zip(enc.encode(pa.array(texts)), want):
        assert got.tolist() == e.ids


def test_shards_round_trip(docs, scratch):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rows = [(i * 7 % 50, f"text {i} of many, Été {i}", "s") for i in range(50)] + [(3, None), (60, ""), (61, "z " * 20000)]
    shards = wavelet.write_shards(docs(rows, extra=True), scratch, tokenizer_path(), END_ID, shard_bytes=300)
    assert shards.count() > 2
    got = sorted(map(tuple, wavelet.read_documents(shards).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(r[0] for r in rows)
    at, left = 0, {}
    for i, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [END_ID]
        left.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for doc, start, n, crc in got:
        assert start == at
        left[doc].remove((n, crc))
        at += n
    empty = wavelet.write_shards(docs([]), scratch, tokenizer_path(), END_ID, name="none")
    assert wavelet.read_documents(empty).count() == 0


def test_encoder_on_random_texts_in_small_pieces(monkeypatch):
    """Latin-1 capitals, marks, special tokens and long texts, cut anywhere."""
    import random

    from tokenizers import Tokenizer

    rnd = random.Random(6)
    signs = ["a", "B", "é", "É", "ÿ", "ß", "×", "÷", "À", "ſ", "'", "-", "<", "|", ">", "1", " ", "\t", "\n", "…", "漢",
             "é", " ", "<|endoftext|>", "Don't", "(x)", "\x1c", "µ", "ª"]
    texts = ["".join(rnd.choices(signs, k=rnd.randint(0, 60))) for _ in range(600)] + [None, "x" * 900, "é" * 700]
    want = [e.ids for e in Tokenizer.from_file(tokenizer_path()).encode_batch(
        [t or "" for t in texts], add_special_tokens=False)]
    for piece in (1 << 20, 50):
        monkeypatch.setattr(wavelet, "PIECE", piece)
        ids, counts = wavelet.Encoder(tokenizer_path()).encode_rows(pa.array(texts))
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("block", [8, 64, 1 << 16])
def test_blocks_of_any_size(block):
    x = np.random.default_rng(block).integers(0, 300, 1000).astype(np.uint32)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(x, block).to_bytes())
    assert [w.access(i) for i in range(1000)] == x.tolist() and (w.decode() == x).all()
    for v in range(0, 300, 7):
        places = np.flatnonzero(x == v)
        assert [w.select(v, k) for k in range(len(places))] == places.tolist()
        assert [w.rank(v, i) for i in (0, 63, 64, 500, 1000)] == [(x[:i] == v).sum() for i in (0, 63, 64, 500, 1000)]


def test_shards_answer_without_being_decoded(spark, docs, scratch):
    rows = [(i, f"word{i % 3} and some more words {'x ' * (i % 7)}", "s") for i in range(60)]
    shards = wavelet.write_shards(docs(rows), scratch, tokenizer_path(), END_ID, shard_bytes=400)
    assert shards.count() > 3
    ids = np.concatenate([wavelet.WaveletMatrix.from_bytes(r.image).decode()
                          for r in sorted(shards.collect(), key=lambda r: r.shard)])
    asked = [0, 5, len(ids) // 2, len(ids) - 1, len(ids), -1]
    got = wavelet.tokens_at(shards, spark.createDataFrame([(p,) for p in asked], "position long")).collect()
    assert {r.position: r.token for r in got} == {p: int(ids[p]) for p in asked[:4]}
    tokens = [END_ID, int(ids[3]), 49_405]
    found = {r.token: (r.n, r.first) for r in wavelet.occurrences(shards, tokens).collect()}
    assert found == {t: (int((ids == t).sum()), int(np.flatnonzero(ids == t)[0]) if (ids == t).any() else None)
                     for t in tokens}


def test_a_question_loads_few_blocks():
    x = np.random.default_rng(1).integers(0, 40_000, 1_000_000).astype(np.uint32)
    data = wavelet.WaveletMatrix.build(x).to_bytes()
    w = wavelet.WaveletMatrix.from_bytes(data)
    assert w.access(654_321) == x[654_321]
    assert sum(len(p.loaded) for p in w.planes) == len(w.planes)  # one of 16 per plane
    w = wavelet.WaveletMatrix.from_bytes(data)
    assert w.count(int(x[7])) == (x == x[7]).sum()
    assert sum(len(p.loaded) for p in w.planes) <= 2 * len(w.planes)
