import random
from collections import Counter

import numpy as np
import pytest

from noticelens.operators import cooccurrence as co


def texts(n=150):
    rng = random.Random(6)
    topics = [[f"t{t}w{k}" for k in range(12)] for t in range(4)]
    return [" ".join(rng.choice(topics[d % 4] if rng.random() < 0.8 else topics[rng.randrange(4)]) for _ in range(30)) for d in range(n)]


def counted(rows, window):
    found = Counter()
    for text in rows:
        words = (text or "").lower().split()
        for i, a in enumerate(words):
            for b in words[i + 1 : i + 1 + window]:
                found[a, b] += 1
                found[b, a] += 1
    return found


def weighed(found):
    own, total = Counter(), sum(found.values())
    for (a, _), n in found.items():
        own[a] += n
    pmi = {p: np.log(n * total / (own[p[0]] * own[p[1]])) for p, n in found.items()}
    return {p: x for p, x in pmi.items() if x > 0}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [*texts(), None, "", "alone", "Twice twice"]
    return rows, spark.createDataFrame(list(enumerate(rows)), "id long, text string")


@pytest.mark.parametrize("chunk", [co.CHUNK, 50])
def test_pairs_and_weights_equal_plain_counting(corpus, chunk, monkeypatch):
    monkeypatch.setattr(co, "CHUNK", chunk)
    rows, df = corpus
    pairs = co.pair_counts(df, "text", window=3)
    want = counted(rows, 3)
    assert {(r.word, r.other): r.n for r in pairs.collect()} == want
    got = {(r.word, r.other): r.pmi for r in co.positive_pmi(pairs).collect()}
    want = weighed(want)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def test_factors_equal_numpy(spark, corpus):
    rows, df = corpus
    found = weighed(counted(rows, 3))
    words = sorted({a for a, _ in found})
    place = {w: n for n, w in enumerate(words)}
    dense = np.zeros((len(words), len(words)))
    for (a, b), x in found.items():
        dense[place[a], place[b]] = x
    values, vectors = np.linalg.eigh(dense)
    order = np.argsort(-np.abs(values))[:3]
    table = {r.word: r.v for r in co.factors(co.positive_pmi(co.pair_counts(df, "text", 3)), 3, rounds=40).collect()}
    got = np.array([table[w] for w in words])
    for n, at in enumerate(order):
        want = vectors[:, at] * np.sqrt(abs(values[at]))
        assert (got[:, n] ** 2).sum() == pytest.approx(abs(values[at]), rel=1e-6)
        assert abs(got[:, n] @ want) == pytest.approx(abs(values[at]), rel=1e-4)
        assert got[np.abs(got[:, n]).argmax(), n] > 0


def test_texts_of_one_topic_are_alike(spark, corpus):
    rows, df = corpus
    words = co.factors(co.positive_pmi(co.pair_counts(df, "text")), 4)
    coded = {r.id: np.array(r.vec_b) for r in co.encode_domain(df, "text", "id", words, 4).collect()}
    assert len(coded) == len(rows) and not coded[150].any() and not coded[152].any()
    near = np.mean([coded[n] @ coded[n + 4] for n in range(100)])
    far = np.mean([coded[n] @ coded[n + 1] for n in range(100)])
    assert near > far + 0.2


def test_few_words_and_no_words(spark):
    df = spark.createDataFrame([(1, "ab cd ab cd")], "id long, text string")
    found = co.factors(co.positive_pmi(co.pair_counts(df, "text")), 3).collect()
    assert {len(r.v) for r in found} <= {3}
    none = df.limit(0)
    assert co.factors(co.positive_pmi(co.pair_counts(none, "text")), 2).count() == 0
