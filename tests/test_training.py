import numpy as np
import pytest

from casegraph.operators import training as tr
from casegraph.operators.model import score


def examples(spark, n, seed, signal=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x @ [1.5, -1.0, 0.5, 0.0] * signal + rng.normal(size=n) > 0.4).astype(int)
    return spark.createDataFrame([(v.tolist(), int(l), "own") for v, l in zip(x, y)], "features array<double>, label int, other string").repartition(3)


def brute(rows, schedule):
    """Weights after all steps, in plain numpy."""
    x = np.array([[*r.features, 1.0] for r in rows])
    y = np.array([r.label for r in rows])
    c = np.where(y == 1, schedule.class_weights[1], schedule.class_weights[0])
    w, m, v = np.zeros(x.shape[1]), 0, 0
    for t in range(1, schedule.epochs + 1):
        g = (c * (1 / (1 + np.exp(-x @ w)) - y)) @ x / c.sum() + schedule.weight_decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - schedule.learning_rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def test_steps_equal_plain_ones_and_learn(spark):
    train, val = examples(spark, 400, 1), examples(spark, 300, 2)
    schedule = tr.Schedule(epochs=30, learning_rate=0.1, every=10)
    trained = tr.train_epochs(train, val, schedule)
    assert [h[0] for h in trained.history] == [10, 20, 30]
    assert trained.validation_auc == max(h[2] for h in trained.history) > 0.8
    assert trained.history[-1][1] < trained.history[0][1]
    last = tr.train_epochs(train, val, tr.Schedule(epochs=30, learning_rate=0.1, every=30))
    assert np.allclose([*last.model.coefficients, last.model.intercept], brute(train.collect(), schedule))
    assert score(trained.model, val).where("prob BETWEEN 0 AND 1").count() == 300


def test_best_epoch_is_kept(spark):
    """Training labels that contradict the validation rows: the first evaluation is the best."""
    trained = tr.train_epochs(examples(spark, 300, 1, -1.0), examples(spark, 300, 2), tr.Schedule(epochs=8, learning_rate=0.3, every=1))
    areas = [h[2] for h in trained.history]
    assert trained.best_epoch == areas.index(max(areas)) + 1
    assert trained.validation_auc == max(areas)


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    train, val, folder = examples(spark, 200, 1), examples(spark, 200, 2), str(tmp_path / "progress")
    schedule = tr.Schedule(epochs=12, learning_rate=0.1, every=3, patience=0)
    whole = tr.train_epochs(train, val, schedule)
    steps, step = [], tr._step

    def fails(state, gradient, schedule):
        if len(steps) == 8:
            raise RuntimeError("lost")
        steps.append(state.epoch)
        return step(state, gradient, schedule)

    monkeypatch.setattr(tr, "_step", fails)
    with pytest.raises(RuntimeError):
        tr.train_epochs(train, val, schedule, folder)
    steps.clear()
    again = tr.train_epochs(train, val, schedule, folder)
    assert steps[0] == 6 and len(steps) == 6
    assert np.allclose(again.model.coefficients, whole.model.coefficients) and again.best_epoch == whole.best_epoch
    assert [h[0] for h in again.history] == [3, 6, 9, 12]


def test_one_class_and_no_rows(spark):
    train = examples(spark, 50, 1)
    one = tr.train_epochs(train, train.where("label = 1"), tr.Schedule(epochs=2, every=1))
    assert one.validation_auc is None and one.best_epoch == 1
    none = tr.train_epochs(train.limit(0), train.limit(0), tr.Schedule(epochs=2, every=1))
    assert none.model.coefficients == () and none.validation_auc is None
