"""Classifier evaluation from one confusion matrix.

The scored rows are aggregated once into the confusion matrix (at most
``classes^2`` rows); accuracy, marginals, per-class precision / recall / F1 and
macro-F1 are all derived from that small table.  No join is needed: each matrix
cell is emitted once as an *actual* count for its true class and once as a
*predicted* count for its predicted class, then summed per class.  Every class
of the class list appears, with zero metrics when it has no true positive
(precision, recall and F1 are 0 when undefined).
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CLASSES = (0.0, 1.0, 2.0)


def confusion_matrix(scored: DataFrame, label: str = "label_index",
                     prediction: str = "prediction") -> DataFrame:
    return (scored.groupBy(F.col(label).alias("label_index"), F.col(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))


def accuracy(scored: DataFrame, label: str = "label_index", prediction: str = "prediction") -> DataFrame:
    """Correct / total; 0 on an empty input."""
    cm = confusion_matrix(scored, label, prediction)
    return cm.agg(F.coalesce(
        F.try_divide(F.sum(F.when(F.col("label_index") == F.col("prediction"), F.col("count")))
                     .cast("double"), F.sum("count").cast("double")),
        F.lit(0.0)).alias("accuracy"))


def _per_class_counts(cm: DataFrame, classes) -> DataFrame:
    spark = cm.sparkSession
    cells = cm.select(
        F.explode(F.array(
            F.struct(F.col("label_index").alias("class_index"), F.col("count").alias("actual"),
                     F.lit(0).cast("bigint").alias("predicted"),
                     F.when(F.col("label_index") == F.col("prediction"), F.col("count"))
                      .otherwise(F.lit(0)).cast("bigint").alias("tp")),
            F.struct(F.col("prediction").alias("class_index"), F.lit(0).cast("bigint").alias("actual"),
                     F.col("count").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
        )).alias("c")).select("c.*")
    zeros = spark.createDataFrame([(float(c), 0, 0, 0) for c in classes],
                                  "class_index double, actual long, predicted long, tp long")
    return (cells.unionByName(zeros).groupBy("class_index")
            .agg(F.sum("tp").alias("true_positive"), F.sum("actual").alias("actual_total"),
                 F.sum("predicted").alias("predicted_total")))


def confusion_marginals(scored: DataFrame, classes=DEFAULT_CLASSES, **kw) -> DataFrame:
    """Per class: actual (row) total and predicted (column) total."""
    counts = _per_class_counts(confusion_matrix(scored, **kw), classes)
    return counts.select("class_index", "actual_total", "predicted_total")


def class_metrics(scored: DataFrame, classes=DEFAULT_CLASSES, **kw) -> DataFrame:
    counts = _per_class_counts(confusion_matrix(scored, **kw), classes)
    tp = F.col("true_positive").cast("double")
    has_tp = F.col("true_positive") > 0
    precision = F.when(has_tp, tp / F.col("predicted_total")).otherwise(F.lit(0.0))
    recall = F.when(has_tp, tp / F.col("actual_total")).otherwise(F.lit(0.0))
    out = counts.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(has_tp, F.lit(2.0) * (F.col("precision") * F.col("recall"))
                / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return out.withColumn("f1_score", f1).orderBy("class_index")


def _fixed_order_mean(cols) -> "F.Column":
    """Mean written as ``(c0 + c1 + ...) / k`` so the float result never depends on row order."""
    total = None
    for c in cols:
        total = c if total is None else total + c
    return total / F.lit(float(len(cols)))


def macro_f1(scored: DataFrame, classes=DEFAULT_CLASSES, **kw) -> DataFrame:
    """Plain mean of F1 over *all* classes of the class list (absent class = 0)."""
    m = class_metrics(scored, classes, **kw)
    f1 = [F.max(F.when(F.col("class_index") == F.lit(float(c)), F.col("f1_score"))) for c in classes]
    return m.agg(_fixed_order_mean([F.coalesce(x, F.lit(0.0)) for x in f1]).alias("macro_f1"))


def metrics_record(scored: DataFrame, labels=("positive", "negative", "neutral"), **kw) -> DataFrame:
    """One row: accuracy, macro-F1 and precision / recall / F1 per named class.

    Class index ``i`` is named ``labels[i]`` (the indexer's label order), not a
    hard-wired position.
    """
    classes = tuple(float(i) for i in range(len(labels)))
    m = class_metrics(scored, classes, **kw)
    aggs = []
    for i, name in enumerate(labels):
        for metric, col in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score")):
            aggs.append(F.max(F.when(F.col("class_index") == F.lit(float(i)), F.col(col)))
                        .alias(f"{name}_{metric}"))
    # diagonal and total over every class, listed or not (integer sums: order-free)
    totals = [F.sum("true_positive").alias("_tp"), F.sum("actual_total").alias("_n")]
    rec = m.agg(*aggs, *totals)
    acc = F.coalesce(F.try_divide(F.col("_tp").cast("double"), F.col("_n").cast("double")), F.lit(0.0))
    macro = _fixed_order_mean([F.col(f"{name}_f1") for name in labels])
    return rec.withColumn("accuracy", acc).withColumn("macro_f1", macro).drop("_tp", "_n")


class MacroF1Evaluator(Evaluator):
    """Spark ML ``Evaluator`` for the plain macro-F1 over a fixed class list.

    ``MulticlassClassificationEvaluator(metricName="f1")`` is the *weighted* F1;
    this one averages per-class F1 equally, absent classes counting 0, so it can
    drive ``TrainValidationSplit`` / ``CrossValidator`` with the project's metric.
    """

    def __init__(self, labelCol: str = "label_index", predictionCol: str = "prediction",
                 classes=DEFAULT_CLASSES):
        super().__init__()
        self.labelCol, self.predictionCol, self.classes = labelCol, predictionCol, tuple(classes)

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(F.col(self.labelCol).cast("double").alias("label_index"),
                                F.col(self.predictionCol).cast("double").alias("prediction"))
        return float(macro_f1(scored, self.classes).first()["macro_f1"])

    def isLargerBetter(self) -> bool:
        return True
