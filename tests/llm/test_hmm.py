import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from helpers import LONG, ODD, docs_frame, prose

from noticelens.llm import hmm
from noticelens.llm.common import id_remainder


def rows():
    out = [r for r in ODD if r[1] is not LONG] + [(55, LONG[:5000])]
    for n in range(40):
        out.append((100 + n, prose(n, 60, 40) if n % 2 else "x" + " x".join(prose(n, 60, 40).split())))
    return [*out, (60, "A a B"), (60, "A a B")]


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def tiny_model(seed, states=3):
    rng = np.random.default_rng(seed)
    emit = rng.random((hmm.CLASSES, states))
    return hmm.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), emit / emit.sum(0))


def test_forward_equals_all_paths():
    model = tiny_model(1)
    texts = [np.array([3, 5, 3, 9]), np.array([7, 3]), np.array([5])]
    got = hmm.forward(model, texts, False)[0]
    for text, value in zip(texts, got):
        total = 0.0
        for path in product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, w in zip(path, path[1:], text[1:]):
                p *= model.move[a, b] * model.emit[w, b]
            total += p
        assert math.isclose(value, math.log(total), rel_tol=1e-12)


def test_expected_counts_equal_all_paths():
    model = tiny_model(2)
    texts = [np.array([3, 5, 3, 9]), np.array([7, 3, 3]), np.array([5])]
    starts, moves, emissions, _ = hmm.expected(model, texts)
    s, m, e = np.zeros(3), np.zeros((3, 3)), np.zeros((hmm.CLASSES, 3))
    for text in texts:
        weights = {}
        for path in product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, w in zip(path, path[1:], text[1:]):
                p *= model.move[a, b] * model.emit[w, b]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            s[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                m[a, b] += p / total
            for k, w in zip(path, text):
                e[w, k] += p / total
    assert np.allclose(starts, s) and np.allclose(moves, m) and np.allclose(emissions, e)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 6, 40) + 6 * (n % 2) for n in range(30)]
    texts.sort(key=len, reverse=True)
    model, last = tiny_model(3), -math.inf
    flat = np.full(hmm.CLASSES, 1e-9)
    for _ in range(6):
        *counts, likelihood = hmm.expected(model, texts)
        assert likelihood > last - 1e-3
        model, last = hmm.reestimated(*counts, flat), likelihood


@pytest.fixture(scope="module")
def scored(spark):
    df = docs_frame(spark, rows())
    return hmm.score(df, held_out=id_remainder("doc_id") == 1, rounds=3).collect()


def test_base_scores(scored):
    data = rows()
    counts = Counter(w for i, t in data if not held(i) for w in tokens(t))
    total, words = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
         round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (words + 1))) for w in tokens(t)), 6))
        for i, t in data
    )
    got = sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored
    )
    assert got == want


def test_scores_beat_the_base_on_held_out_texts(scored):
    some = [r for r in scored if r.held_out and r.n_tokens > 30]
    assert some and sum(r.score for r in some) > sum(r.base_score for r in some)
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored)


def test_chunks_do_not_change_the_scores(spark, scored, monkeypatch):
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 700)
    monkeypatch.setattr(hmm, "CELLS", 100)
    df = docs_frame(spark, rows())
    again = hmm.score(df, held_out=id_remainder("doc_id") == 1, rounds=3).collect()
    one, two = (sorted((str(r.doc_id), round(r.score, 6)) for r in x) for x in (scored, again))
    assert one == two


def test_words_of_their_own_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(hmm, "OWN", 3)
    df = spark.createDataFrame([(b"a", 9), (b"b", 9), (b"c", 5), (b"d", 4), (b"e", 4), (b"f", 0)], "word binary, c long")
    counts = hmm.count_classes(df, 7)
    assert sorted(counts.own) == [b"a", b"b", b"c"]
    assert (counts.tokens, counts.words) == (38, 6)


def test_empty_and_untrained(spark):
    df = docs_frame(spark, [(1, "a b")])
    assert hmm.score(df.limit(0)).count() == 0
    lone = hmm.score(df, held_out=id_remainder("doc_id") >= 0).first()
    assert (lone.train_tokens, lone.n_known, lone.base_score) == (0, 0, 0.0)
    assert math.isfinite(lone.score)
