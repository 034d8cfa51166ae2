"""The exchange over all clustered words, recounted in plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from stratus.llm import brown


def rows(seed):
    rng = random.Random(seed)

    def text():
        return " ".join(rng.choice(["the", "a"]) + f" n{rng.randrange(4200)}s" + rng.choice([" runs", " sleeps"])
                        + (f" q{rng.randrange(2500)}ly" if rng.random() < 0.6 else "") for _ in range(rng.randrange(50)))
    return [(i, text()) for i in range(700)] + [(800, None), (801, "once the")]


def ranked(found):
    """(lexicon, word -> rank, texts as words) of the words that occur twice."""
    texts = [(t or "").split() for _, t in found]
    counts = {}
    for t in texts:
        for w in t:
            counts[w] = counts.get(w, 0) + 1
    names = sorted((w for w in counts if counts[w] > 1), key=lambda w: (-counts[w], w))
    groups = {w: next(brown._token_groups(pa.array([w]))) for w in counts}
    lexicon = brown.Lexicon(np.concatenate([groups[w][0] for w in names]), np.array([counts[w] for w in names], float))
    tail = {w: int(groups[w][1][0]) for w in counts}
    return lexicon, {w: k for k, w in enumerate(names)}, tail, texts


def test_whole_vocabulary_steps_and_moves(spark, docs):
    found = rows(1)
    lexicon, rank, tail, texts = ranked(found)
    assert len(rank) > brown.SEED_WORDS + 500
    df = docs(found).select("text").repartition(5)
    v = brown.Vocabulary(df.mapInArrow(brown._bigrams(lexicon), "pair long, n long"), brown.links(df, lexicon))
    of = np.random.default_rng(2).integers(0, brown._END_CLASS, len(rank))
    step = np.zeros((brown._ALL, brown._ALL))
    near = np.zeros((len(rank), 2 * brown._ALL))  # classes before a word, then those after it
    for t in texts:
        c = [brown._END_CLASS, *(of[rank[w]] if w in rank else brown.CLASSES + tail[w] for w in t), brown._END_CLASS]
        for x, y in zip(c, c[1:]):
            step[x, y] += 1
        for k, w in enumerate(t):
            if w in rank:
                near[rank[w], c[k]] += 1
                near[rank[w], brown._ALL + c[k + 2]] += 1
    assert (v.steps(of) == step).all()
    pull = brown._pull(step)
    gain = near @ np.concatenate((pull[:, :brown.CLASSES], pull[:brown.CLASSES].T))
    new = v.moved(of, step, parts=2, turn=1)
    go = np.arange(len(of)) % 2 == 1
    assert (new[~go] == of[~go]).all()
    assert gain[go, new[go]] == pytest.approx(gain[go].max(1))
    assert (v.moved(of, step, least=brown.SEED_WORDS)[:brown.SEED_WORDS] == of[:brown.SEED_WORDS]).all()


def test_words_beyond_the_seeds_are_exchanged_in_rounds(spark, docs, scratch, monkeypatch):
    found = rows(3)
    lexicon, rank, tail, texts = ranked(found)
    df = docs(found).select("text")
    model, _, _ = brown.train(df, scratch)
    got = dict(zip(model.lexicon.words.tolist(), model.of.tolist()))
    # The seeds' rounds and one sweep alone.
    monkeypatch.setattr(brown, "ROUNDS", 0)
    pairs = df.mapInArrow(brown._bigrams(model.lexicon), "pair long, n long")
    classes, step, _ = brown.exchange(pairs, 6)
    tails = np.empty(len(rank), int)
    of_name = {int(brown._token_groups(pa.array([w])).__next__()[0][0]): w for w in rank}
    for k, h in enumerate(model.lexicon.words.tolist()):
        tails[k] = tail[of_name[h]]
    swept, after, _ = brown.sweep(df, model.lexicon, classes, step, tails)
    final = np.zeros_like(after)
    for t in texts:
        c = [brown._END_CLASS, *(got[int(next(brown._token_groups(pa.array([w])))[0][0])] if w in rank
                                 else brown.CLASSES + tail[w] for w in t), brown._END_CLASS]
        np.add.at(final, (c[:-1], c[1:]), 1)
    assert brown.likelihood(final) > brown.likelihood(after)
    rest = model.lexicon.rank >= brown.SEED_WORDS
    assert (model.of[rest] != swept[rest]).any()


def test_the_vocabulary_holds_as_many_words_as_it_may(spark, monkeypatch):
    words = spark.createDataFrame([(k, 0, n) for k, n in enumerate([2] * 50 + [3] * 30 + [40] * 10 + [1] * 90)],
                                  "word long, tail long, n long")
    for share, want in ((1 / 200, 2), (1 / 90, 2), (1 / 89, 3), (1 / 39, 4), (1 / 10, 4)):
        monkeypatch.setattr(brown, "SHARE", share)
        assert brown._least_count(words, 680) == want, share
