"""Dashboard tables merged from per-batch rollups (``sources.rollups``) instead of store rows.

Each function gives what its namesake in ``operators.monitor`` gives over the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiscope.functions.labels import UNKNOWN
from sentiscope.functions.probability import percent
from sentiscope.operators import monitor as M
from sentiscope.operators.stats import merge_counts

def _n():
    return F.sum("n").cast("bigint")


def _average():
    return percent(F.sum("sum_confidence") / F.sum("n_confidence"))


def _rows(condition):
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")


def sentiment_summary(cells: DataFrame) -> DataFrame:
    counts = cells.where("predicted_label is not null").groupBy(F.col("predicted_label").alias("sentiment")).agg(_n().alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # one row per sentiment
    return counts.withColumn("percentage", F.round(F.col("count") / total * F.lit(100.0), 2)).orderBy(F.col("count").desc(), "sentiment")


def score_distribution(cells: DataFrame) -> DataFrame:
    return cells.where("score is not null").groupBy("score").agg(_n().alias("count")).orderBy("score")


def confidence_by_sentiment(cells: DataFrame) -> DataFrame:
    return (cells.where("predicted_label is not null").groupBy("predicted_label")
            .agg(_average().alias("average_confidence")).orderBy("predicted_label"))


def batch_summary(cells: DataFrame) -> DataFrame:
    return (cells.where("batch_id is not null").groupBy("batch_id").agg(_n().alias("records")).orderBy(F.col("batch_id").desc()))


def confidence_histogram(cells: DataFrame) -> DataFrame:
    counts = cells.agg(*[_rows(F.col("bin") == i).alias(f"c{i}") for i in range(len(M.CONFIDENCE_LABELS))])
    parts = ", ".join(f"{i}, '{label}', c{i}" for i, label in enumerate(M.CONFIDENCE_LABELS))
    return (counts.selectExpr(f"stack({len(M.CONFIDENCE_LABELS)}, {parts}) AS (bin, confidence_range, count)")
            .select(F.col("bin").cast("int"), "confidence_range", "count").orderBy("bin"))


def score_by_sentiment(cells: DataFrame) -> DataFrame:
    return (cells.where("score is not null and predicted_label is not null").groupBy("score", "predicted_label")
            .agg(_n().alias("count")).orderBy("score", "predicted_label"))


def score_sentiment_crosstab(cells: DataFrame, sentiments=(*M.SENTIMENTS, UNKNOWN)) -> DataFrame:
    label = F.col("predicted_label")
    named = [_rows(label == s).alias(s) for s in sentiments]
    return (cells.where("score is not null and predicted_label is not null").groupBy("score")
            .agg(*named, _rows(~label.isin(*sentiments)).alias("other")).orderBy("score"))


def status_kpis(cells: DataFrame) -> DataFrame:
    label = F.col("predicted_label")
    return cells.agg(
        F.coalesce(_n(), F.lit(0)).cast("bigint").alias("total_predictions"), F.max("batch_id").alias("latest_batch_id"),
        _average().alias("average_confidence"), *[_rows(label == s).alias(f"{s}_count") for s in ("positive", "negative", "neutral")],
        F.coalesce(F.sum("n_low"), F.lit(0)).cast("bigint").alias("low_confidence_count"))


def confidence_stats(values: DataFrame) -> DataFrame:
    return M.confidence_stats(None, counts=values)


def report_summary(cells: DataFrame, values: DataFrame) -> DataFrame:
    from sentiscope.plans import report

    return report.report_summary(None, counts=merge_counts(values), batches=batch_summary(cells))
