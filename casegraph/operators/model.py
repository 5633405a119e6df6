"""Training, selection, scoring and cached predictions of an outcome model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from casegraph.functions.scalars import softmax2
from casegraph.operators.metrics import auc

# Loss weights of the classes survived and died.
CLASS_WEIGHTS = (1.0, 1.5)


def with_class_weights(df: DataFrame, label: str = "label", weights: tuple[float, float] = CLASS_WEIGHTS) -> DataFrame:
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])))


@dataclass(frozen=True)
class LinearModel:
    """Plain numbers: a fitted Spark model carries its training summary, and with it the session."""

    coefficients: tuple[float, ...]
    intercept: float


@dataclass
class TrainedModel:
    model: LinearModel
    reg_param: float
    validation_auc: float | None


def train(
    training: DataFrame, validation: DataFrame, reg_params: Sequence[float] = (0.0, 1e-2), max_iter: int = 40,
    tol: float = 1e-6,
) -> TrainedModel:
    """Weighted logistic regression on ``features``; the strength with the best validation AUC wins.

    The optimiser keeps the coefficients on the driver and reads the training rows on the
    executors once per iteration, so both inputs are kept in memory, spilling to disk.
    """
    def prepared(df: DataFrame) -> DataFrame:
        return df.withColumn("vector", array_to_vector("features")).persist(StorageLevel.MEMORY_AND_DISK)

    rows, held_out = prepared(with_class_weights(training)), prepared(validation)
    best: TrainedModel | None = None
    try:
        for reg in reg_params:
            estimator = LogisticRegression(
                featuresCol="vector", labelCol="label", weightCol="weight", regParam=reg, maxIter=max_iter,
                tol=tol,
            )
            found = estimator.fit(rows)
            fitted = LinearModel(tuple(map(float, found.coefficients)), float(found.intercept))
            value = auc(score(fitted, held_out)).first()["auc"]
            if best is None or (value or 0.0) > (best.validation_auc or 0.0):
                best = TrainedModel(fitted, reg, value)
    finally:
        rows.unpersist()
        held_out.unpersist()
    return best


def score(model: LinearModel, df: DataFrame) -> DataFrame:
    """Adds ``prob`` and ``pred``: the softmax of zero and the weighted sum of ``features``, as one expression."""
    weights = F.array(*(F.lit(float(w)) for w in model.coefficients))
    products = F.zip_with("features", weights, lambda x, w: x * w)
    total = F.aggregate(products, F.lit(float(model.intercept)), lambda total, x: total + x)
    return df.withColumn("prob", softmax2(F.lit(0.0), total)).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))


def cached_predictions(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Stored predictions, or those of ``compute`` after storing them.

    A folder counts as complete only with its success marker.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    stored = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    if not stored:
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
