"""Training by epochs with the best epoch kept: full-batch Adam steps whose gradients are added up on the executors.

The training rows are packed once into blocks of numbers. A step sends the coefficients to all tasks; a task returns the sums
over its rows, a few numbers, which the driver adds up. Every so many epochs the model is scored on the validation rows; the epoch with the
best area under the curve is kept, and the step size is halved when it has not risen for long. With a progress folder
each evaluation is stored, and a run that starts again goes on behind the last one stored.

* no rows or one class only: the area is null, and the first evaluated epoch is kept;
* rows whose ``features`` differ in length from the first row's are an error;
* other columns are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from casegraph.operators.metrics import auc
from casegraph.operators.model import CLASS_WEIGHTS, LinearModel, score

# Decay of the two moments, and what keeps a division from zero.
_BETAS = (0.9, 0.999)
_EPSILON = 1e-8
# Fixed value: by how much, relatively, the area must rise to count as better for the step size.
_THRESHOLD = 1e-4


@dataclass(frozen=True)
class Schedule:
    epochs: int = 300
    learning_rate: float = 1e-3
    weight_decay: float = 1e-4
    class_weights: tuple[float, float] = CLASS_WEIGHTS
    #: Epochs between two evaluations.
    every: int = 10
    #: Evaluations without a better area before the step size is multiplied by ``factor``.
    patience: int = 20
    factor: float = 0.5


@dataclass(frozen=True)
class State:
    """All that a run needs to go on; the intercept is the last of the weights."""

    epoch: int
    weights: list[float]
    first_moment: list[float]
    second_moment: list[float]
    learning_rate: float
    best_epoch: int = 0
    best_auc: float | None = None
    best_weights: list[float] | None = None
    plateau_auc: float | None = None
    waited: int = 0
    history: list[list] = field(default_factory=list)  # epoch, loss, area, whether it was the best so far


@dataclass(frozen=True)
class Trained:
    model: LinearModel
    best_epoch: int
    validation_auc: float | None
    #: Epoch, loss, validation area, best so far.
    history: list[tuple[int, float, float | None, bool]]


def _blocks(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` features, an intercept's one and the label of many rows as one block of numbers, so that a step moves few and large values."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            block = np.column_stack([x, np.ones(batch.num_rows), y]).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], type=pa.binary())], names=["block"])

    return rows.select("features", "label").mapInArrow(pack, "block binary")


def _gradient(blocks: DataFrame, weights: Sequence[float], class_weights: tuple[float, float]) -> tuple[np.ndarray, float]:
    """Weighted mean gradient and loss of the cross-entropy of all rows."""
    w = np.array(weights, dtype=float)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) + 2)
        for batch in batches:
            for block in batch.column(0):
                rows = np.frombuffer(block.as_buffer(), dtype=float).reshape(-1, len(w) + 1)
                x, y = rows[:, :-1], rows[:, -1]
                weight = np.where(y == 1, class_weights[1], class_weights[0])
                margin = x @ w
                p = 1.0 / (1.0 + np.exp(-margin))
                total[:-2] += (weight * (p - y)) @ x
                total[-2] += weight @ np.logaddexp(0.0, np.where(y == 1, -margin, margin))
                total[-1] += weight.sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], type=pa.list_(pa.float64()))], names=["sums"])

    parts = blocks.mapInArrow(add, "sums array<double>").collect()  # a few numbers a task
    sums = np.sum([p["sums"] for p in parts], axis=0) if parts else np.zeros(len(w) + 2)
    return sums[:-2] / (sums[-1] or 1.0), float(sums[-2] / (sums[-1] or 1.0))


def _step(state: State, gradient: np.ndarray, schedule: Schedule) -> State:
    w, m, v = (np.array(a) for a in (state.weights, state.first_moment, state.second_moment))
    epoch, (b1, b2) = state.epoch + 1, _BETAS
    g = gradient + schedule.weight_decay * w
    m, v = b1 * m + (1 - b1) * g, b2 * v + (1 - b2) * g * g
    w = w - state.learning_rate * (m / (1 - b1**epoch)) / (np.sqrt(v / (1 - b2**epoch)) + _EPSILON)
    return replace(state, epoch=epoch, weights=w.tolist(), first_moment=m.tolist(), second_moment=v.tolist())


def _linear(weights: Sequence[float]) -> LinearModel:
    return LinearModel(tuple(weights[:-1]), float(weights[-1]))


def _evaluated(state: State, loss: float, area: float | None, schedule: Schedule) -> State:
    better = state.best_weights is None or (area or 0.0) > (state.best_auc or 0.0)
    history = [*state.history, [state.epoch, loss, area, better]]
    if better:
        state = replace(state, best_epoch=state.epoch, best_auc=area, best_weights=state.weights)
    rose = state.plateau_auc is None or (area or 0.0) > state.plateau_auc * (1 + _THRESHOLD)
    waited = 0 if rose else state.waited + 1
    if rose:
        state = replace(state, plateau_auc=area or 0.0)
    if waited > schedule.patience:
        state, waited = replace(state, learning_rate=state.learning_rate * schedule.factor), 0
    return replace(state, waited=waited, history=history)


def _stored_epochs(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    done = [n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("epoch-")) for n in done if n.startswith("epoch-"))


def _load(spark: SparkSession, folder: str) -> State | None:
    epochs = _stored_epochs(spark, folder)
    if not epochs:
        return None
    return State(**json.loads(spark.read.text(f"{folder}/epoch-{epochs[-1]:06d}").first()["value"]))


def _store(spark: SparkSession, folder: str, state: State) -> None:
    row = spark.createDataFrame([(json.dumps(asdict(state)),)], "value string").coalesce(1)
    row.write.mode("overwrite").text(f"{folder}/epoch-{state.epoch:06d}")


def train_epochs(
    training: DataFrame, validation: DataFrame, schedule: Schedule = Schedule(), progress: str | None = None
) -> Trained:
    """Logistic regression on ``features`` and ``label`` of ``training``, chosen by the epochs' areas on ``validation``."""
    spark = training.sparkSession
    held_out = validation.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    rows = None
    try:
        state = _load(spark, progress) if progress else None
        if state is None:
            sizes = (df.select(F.size("features").alias("n")).first() for df in (training, held_out))
            zeros = [0.0] * (next((s["n"] for s in sizes if s), 0) + 1)
            state = State(0, zeros, zeros, zeros, schedule.learning_rate)
        rows = _blocks(training, len(state.weights) - 1).persist(StorageLevel.MEMORY_AND_DISK)
        while state.epoch < schedule.epochs:
            gradient, loss = _gradient(rows, state.weights, schedule.class_weights)
            state = _step(state, gradient, schedule)
            if state.epoch % schedule.every == 0 or state.epoch == schedule.epochs:
                area = auc(score(_linear(state.weights), held_out)).first()["auc"]
                state = _evaluated(state, loss, area if area is None or math.isfinite(area) else None, schedule)
                if progress:
                    _store(spark, progress, state)
    finally:
        if rows is not None:
            rows.unpersist()
        held_out.unpersist()
    best = state.best_weights or state.weights
    return Trained(_linear(best), state.best_epoch, state.best_auc, [tuple(h) for h in state.history])
