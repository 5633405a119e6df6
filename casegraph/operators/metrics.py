"""Evaluation of binary predictions; ``label`` is 0/1, ``prob`` the probability of class 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegraph.operators.ranking import prefix_sums


def auc(df: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null if a class is absent.

    Rows are first counted per distinct score, then each score needs the number of
    negatives below it (distributed prefix sums).
    """
    per_score = df.groupBy(F.col(prob).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"), F.sum((F.col(label) == 0).cast("bigint")).alias("neg")
    )
    ranked = prefix_sums(per_score, "score", ["neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg((won / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row with tn, fp, fn, tp."""
    def cell(y: int, p: int):
        return F.count(F.when((F.col(label) == y) & (F.col(pred) == p), 1))

    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """All four (label, pred, n) cells, also the empty ones."""
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    rows = [F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(n).alias("n")) for n, y, p in cells]
    return confusion_counts(df, label, pred).select(F.inline(F.array(*rows)))


def precision_recall_f1(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row; a ratio without a denominator is 0."""
    def ratio(top, bottom):
        return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion_counts(df, label, pred).select(
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metric_report(df: DataFrame, label: str = "label", prob: str = "prob", threshold: float = 0.5) -> DataFrame:
    """(metric, value) rows: auc, f1, precision, recall."""
    scored = df.withColumn("pred", (F.col(prob) >= threshold).cast("int"))
    def long(row: DataFrame, names: list[str]) -> DataFrame:
        return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))

    return long(auc(df, label, prob), ["auc"]).unionByName(
        long(precision_recall_f1(scored, label), ["f1", "precision", "recall"])
    )
