"""What a task's Python holds: classifier fit, Arrow batches, remembered pieces."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratus.llm import decontaminate, jaccard, toxicity, wavelet
from stratus.llm.queries import END_ID, tokenizer_path
from stratus.llm.scratch import BATCH_BYTES, Scratch

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def texts_of(n, words, vocabulary, seed=5):
    rng = random.Random(seed)
    said = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 11))) for _ in range(vocabulary)]
    return [np.frombuffer(" ".join(rng.choice(said) for _ in range(rng.randint(0, words))).encode(), np.uint8)
            for _ in range(n)]


def peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_fit_holds_a_few_times_its_texts():
    texts = texts_of(1500, 600, 200_000)
    labels = np.arange(len(texts)) % 9 == 0
    used = peak(lambda: toxicity.fit(texts, labels, epochs=2))
    assert used < 30 * sum(map(len, texts))


@pytest.mark.parametrize("block", [1, 97, 5000])
def test_fit_is_the_same_in_any_blocks(monkeypatch, block):
    texts = texts_of(60, 40, 90) + [np.empty(0, np.uint8), np.frombuffer(b" \n", np.uint8)] + texts_of(1, 900, 90)
    labels = np.arange(len(texts)) % 4 == 0
    whole = toxicity.fit(texts, labels, epochs=15)
    monkeypatch.setattr(toxicity, "FIT_BLOCK", block)
    parts = toxicity.fit(texts, labels, epochs=15)
    assert parts.table.any() and (parts.table == whole.table).all() and parts.bias == whole.bias


def test_words_are_numbered_and_cut_into_their_grams():
    texts = texts_of(40, 30, 50)
    doc_cut, passage_cut, entries, gram_cut, buckets = toxicity._features(texts)
    at = 0
    for k, raw in enumerate(texts):
        said = raw.tobytes().decode().split()
        starts = [0] if len(said) <= 4 else [*range(0, len(said) - 3, 2), len(said) - 4]
        assert doc_cut[k + 1] - doc_cut[k] == len(starts)
        for s in starts:
            words = entries[passage_cut[at]: passage_cut[at + 1]]
            assert len(words) == len(said[s: s + 4])
            for number, word in zip(words, said[s: s + 4]):
                alone = np.concatenate([b for _, b in toxicity._grams(
                    toxicity.codes(np.frombuffer(f"{word} ".encode(), np.uint8)))])
                assert sorted(buckets[gram_cut[number]: gram_cut[number + 1]]) == sorted(alone)
            at += 1
    assert at == len(passage_cut) - 1


@pytest.mark.parametrize("name", ["toxicity", "near_duplicates", "leaks", "shards"])
def test_batches_are_bounded(spark, name):
    own = spark.newSession()
    docs = own.createDataFrame([(i, f"w{i} some words") for i in range(4)], "doc_id long, text string")
    items = own.createDataFrame([(1, "another text")], "item_id long, text string")
    labels = own.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    scratch = Scratch(own, f"batches-{name}")
    start = {"toxicity": lambda: toxicity.train(docs, labels),
             "near_duplicates": lambda: jaccard.near_duplicates(docs, scratch),
             "leaks": lambda: decontaminate.leaks(docs, items, scratch),
             "shards": lambda: wavelet.write_shards(docs, scratch, tokenizer_path(), END_ID)}[name]
    start()

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    long = own.range(3000, numPartitions=1).select(F.concat("id", F.repeat(F.lit("x"), 4000)).alias("text"))
    found = [r["n"] for r in long.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 2 * BATCH_BYTES and max(found) <= 1.1 * BATCH_BYTES
    own.conf.set(KEY, "1m")  # a size that was set stays
    start()
    assert own.conf.get(KEY) == "1m"


def test_remembered_pieces_are_small():
    enc = wavelet.Encoder(tokenizer_path())
    rng = random.Random(8)
    rows = [" ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(2000)) for _ in range(60)]
    first = [x.tolist() for x in enc.encode(pa.array(rows[:3]))]
    wavelet.powers(2 * wavelet.PIECE)  # a table of its own, of fixed size
    tracemalloc.start()
    try:
        enc.encode(pa.array(rows))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 64 * 2000 * 60
    assert [x.tolist() for x in enc.encode(pa.array(rows[:3]))] == first  # now from memory
