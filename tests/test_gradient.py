import hashlib
import re

import numpy as np
import pytest

from noticelens.operators.gradient import AdamW, Descent, dropped_cells, predict, train
from noticelens.operators.objectives import Objective, Sums, batch_sums, log_softmax, with_bias
from noticelens.plans import training

CLASSES, CELLS = 3, 4
OBJECTIVES = [
    Objective("focal"),
    Objective("focal", gamma=0.5),
    Objective("focal", gamma=0.0),
    Objective("smoothed", smoothing=0.2),
    Objective("focal", consistency=0.7),
    Objective("smoothed", consistency=0.4),
]


def data(seed=0, n=60):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, CLASSES, n)
    x = rng.normal(size=(n, CELLS)) + np.eye(CLASSES, CELLS)[y] * 1.5
    return x, x + rng.normal(size=x.shape) * 0.2, y, np.array([0.5, 1.0, 2.0])


@pytest.mark.parametrize("objective", OBJECTIVES)
def test_gradients_equal_finite_differences(objective):
    x, other, y, weights = data()
    model = np.random.default_rng(1).normal(size=(CLASSES, CELLS + 1))
    value, grad = batch_sums(objective, model, x, other, y, weights).total(objective)
    for place in np.ndindex(model.shape):
        step = np.zeros_like(model)
        step[place] = 1e-6
        up, down = (batch_sums(objective, model + s, x, other, y, weights).total(objective)[0] for s in (step, -step))
        assert grad[place] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_adversarial_part():
    """The loss at the shifted rows, with the shift held constant."""
    x, _, y, weights = data()
    model = np.random.default_rng(1).normal(size=(CLASSES, CELLS + 1))
    plain, hard = Objective("smoothed", smoothing=0.0), Objective("smoothed", smoothing=0.0, adversarial=0.5, epsilon=0.3)
    one = np.ones(CLASSES)
    p = np.exp(log_softmax(with_bias(x) @ model.T)) - np.eye(CLASSES)[y]
    toward = p @ model[:, :-1]
    moved = x + 0.3 * toward / (np.linalg.norm(toward, axis=1, keepdims=True) + 1e-8)
    a, b = batch_sums(plain, model, x, x, y, one), batch_sums(plain, model, moved, moved, y, one)
    got = batch_sums(hard, model, x, x, y, one)
    assert got.main == pytest.approx(a.main + 0.5 * b.main) and b.main > a.main
    assert np.allclose(got.main_grad, a.main_grad + 0.5 * b.main_grad)


def test_losses_by_hand():
    model = np.array([[1.0, 0.0], [0.0, 0.5]])
    x, y, weights = np.array([[2.0]]), np.array([1]), np.array([1.0, 3.0])
    z = np.array([2.0, 0.5])
    ce = -3.0 * (0.5 - np.log(np.exp(z).sum()))
    focal = batch_sums(Objective("focal"), model, x, x, y, weights)
    assert focal.main == pytest.approx((1 - np.exp(-ce)) ** 2 * ce) and focal.main_by == 1.0
    logp = z - np.log(np.exp(z).sum())
    smoothed = batch_sums(Objective("smoothed", smoothing=0.1), model, x, x, y, weights)
    assert smoothed.main == pytest.approx(-0.9 * 3 * logp[1] - 0.05 * (logp[0] + 3 * logp[1])) and smoothed.main_by == 3.0
    assert Sums.of(focal.flat(), model.shape).main_grad.tolist() == focal.main_grad.tolist()


def frame(spark, folds=3):
    x, other, y, weights = data(3, 200)
    rows = [(n, a.tolist(), b.tolist(), int(c), n % folds) for n, (a, b, c) in enumerate(zip(x, other, y))]
    rows += [(900, None, None, 1, 0), (901, x[0].tolist(), other[0].tolist(), None, 1)]
    return spark.createDataFrame(rows, "id long, features array<double>, second array<double>, label int, fold int"), (x, other, y, weights)


@pytest.mark.parametrize("optimiser", [Descent(0.3), AdamW(0.05)])
def test_all_folds_in_one_pass_equal_separate_fits(spark, optimiser):
    df, (*_, weights) = frame(spark)
    objective = Objective("focal", consistency=0.3)
    options = dict(optimiser=optimiser, steps=4, weights=weights, second="second", penalty=0.01)
    together = train(df.repartition(5), CLASSES, objective, folds=3, **options)
    for k in range(3):
        alone = train(df.filter(f"fold != {k}"), CLASSES, objective, **options)
        assert np.allclose(alone.models[0], together.models[k], atol=1e-12)
        assert np.allclose([v[0] for v in alone.values], [v[k] for v in together.values])


def test_equals_training_on_arrays(spark):
    df, (x, other, y, weights) = frame(spark)
    objective = Objective("smoothed", consistency=0.2)
    fit = train(df, CLASSES, objective, Descent(0.5), steps=6, weights=weights, second="second")
    model, values = np.zeros((CLASSES, CELLS + 1)), []
    for _ in range(6):
        value, grad = batch_sums(objective, model, x, other, y, weights).total(objective)
        values.append(value)
        model = model - 0.5 * grad
    assert np.allclose(model, fit.models[0]) and np.allclose(values, [v[0] for v in fit.values[:-1]])
    assert fit.values[-1][0] < fit.values[0][0]
    scored = predict(df, fit).collect()
    assert [r.pred for r in scored if r.id == 900] == [None]
    assert np.mean([r.pred == r.label for r in scored if r.id < 900]) > 0.55


def test_adamw_by_hand():
    """Two steps of the published rule, with linear rise and fall of the rate."""
    rule, grads = AdamW(rate=0.1, decay=0.01, warmup=0.5), [np.array([[1.0, -2.0]]), np.array([[0.5, 0.5]])]
    state, w, m, v = rule.start((1, 2)), np.array([[0.3, 0.4]]), 0.0, 0.0
    for step, grad in enumerate(grads):
        got = rule.move(state, step, 4, w, grad)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        rate = 0.1 * [0.0, 0.5][step]
        part = (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)
        w = w - rate * (part + np.array([[0.01, 0.0]]) * w)
        assert np.allclose(got, w)


def test_scales_weigh_cells_for_each_model(spark):
    df, (x, _, y, _) = frame(spark, folds=2)
    scales = np.array([[1.0, 2.0, 0.5, 1.0], [3.0, 1.0, 1.0, 0.0]])
    fit = train(df, CLASSES, Objective("focal"), Descent(0.2), steps=3, folds=2, scales=scales)
    for k in range(2):
        own = np.arange(len(x)) % 2 != k
        cells = x[own] * scales[k]
        cells = cells / np.linalg.norm(cells, axis=1, keepdims=True)
        model = np.zeros((CLASSES, CELLS + 1))
        for _ in range(3):
            model = model - 0.2 * batch_sums(Objective("focal"), model, cells, cells, y[own], np.ones(CLASSES)).total(Objective("focal"))[1]
        assert np.allclose(model, fit.models[k])


def test_odd_inputs(spark):
    df, _ = frame(spark)
    none = train(df.limit(0), CLASSES, steps=1)
    assert none.models.shape == (1, CLASSES, 1) and none.values[0] == [0.0]
    uneven = spark.createDataFrame([([1.0], 0), ([1.0, 2.0], 1)], "features array<double>, label int")
    with pytest.raises(ValueError):
        train(uneven, 2)
    with pytest.raises(ValueError):
        Objective("other")


def test_second_views_drop_the_share_asked_for(spark):
    df, _ = frame(spark)
    views = df.filter("features is not null").select(dropped_cells("features", "id", 0.25).alias("v")).collect()
    cells = np.array([r.v for r in views])
    assert 0.15 < (cells == 0).mean() < 0.35


def test_words_are_counted_by_bucket_where_their_row_lies(spark, capsys):
    """No shuffle of words, and rows of one text stay apart."""
    texts = ["Road road b the  공사_1", "", None, "x", "Road road b the  공사_1", "word " * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(2)
    coded = training.bucket_counts(rows, "text", 8)
    coded.explain()
    assert "Exchange" not in capsys.readouterr().out
    want = []
    for n, text in enumerate(texts):
        cells = [0.0] * 8
        for word in re.findall(r"\w\w+", (text or "").lower()):
            cells[int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % 8] += 1.0
        want.append((n, text, cells))
    assert [tuple(r) for r in coded.orderBy("id").collect()] == want
