"""Operators over the hyper-parameter trial log (one row per trial).

The trial log is tiny (one row per model fit), so the single-partition windows
below run over at most a few hundred rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIAL_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType(), False),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("accepted", T.BooleanType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("sample_size", T.IntegerType(), True),
    T.StructField("vocab_size", T.IntegerType(), True),
    T.StructField("min_df", T.IntegerType(), True),
    T.StructField("max_iter", T.IntegerType(), True),
    T.StructField("reg_param", T.DoubleType(), True),
    T.StructField("use_bigrams", T.BooleanType(), True),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("macro_f1", T.DoubleType(), True),
    T.StructField("positive_f1", T.DoubleType(), True),
    T.StructField("negative_f1", T.DoubleType(), True),
    T.StructField("neutral_f1", T.DoubleType(), True),
    T.StructField("positive_precision", T.DoubleType(), True),
    T.StructField("positive_recall", T.DoubleType(), True),
    T.StructField("negative_precision", T.DoubleType(), True),
    T.StructField("negative_recall", T.DoubleType(), True),
    T.StructField("neutral_precision", T.DoubleType(), True),
    T.StructField("neutral_recall", T.DoubleType(), True),
])


def acceptance_column(current: Column, candidate: Column, temperature: Column) -> Column:
    """Metropolis rule as one clamped exponential: a gain counts as no loss, so it gives 1."""
    loss = F.greatest(current - candidate, F.lit(0.0))
    return F.exp(-loss / temperature)


def acceptance_probability(current: float, candidate: float, temperature: float) -> float:
    """Scalar form of :func:`acceptance_column`."""
    return math.exp(-max(0.0, current - candidate) / temperature)


def trial_ranking(trials: DataFrame) -> DataFrame:
    """Rank by macro-F1 descending; equal scores keep step order (stable sort)."""
    w = Window.orderBy(F.col("macro_f1").desc(), F.col("step").asc())
    return trials.withColumn("rank", F.row_number().over(w)).orderBy("rank")


def best_trial(trials: DataFrame) -> DataFrame:
    """Running arg-max with strict improvement: the earliest step reaching the best score."""
    best = trials.agg(F.min_by("step", F.struct(-F.col("macro_f1"), F.col("step"))).alias("best_step"))
    return trials.join(best, trials.step == best.best_step, "left_semi")


def with_acceptance(trials: DataFrame) -> DataFrame:
    """Recompute each step's acceptance probability from the log.

    The current score at step ``s`` is the score of the last accepted trial
    before ``s``; the logged temperature is the one used at that step.
    """
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    current = F.last(F.when(F.col("accepted"), F.col("macro_f1")), ignorenulls=True).over(w)
    return (trials.withColumn("current_macro_f1", current)
            .withColumn("acceptance_probability",
                        F.when(F.col("current_macro_f1").isNull(), F.lit(1.0))
                        .otherwise(acceptance_column(F.col("current_macro_f1"), F.col("macro_f1"),
                                                     F.col("temperature")))))
