"""Registered evaluation queries over the ``scored`` relation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentiscope.catalog import register
from sentiscope.operators import evaluate as V
from sentiscope.sources.fixtures import scored

CM_SQL = "cm AS (SELECT label_index, prediction, count(*) AS count FROM src GROUP BY label_index, prediction)"
COUNTS_SQL = """
cells AS (
  SELECT label_index AS class_index, count AS actual, 0 AS predicted,
         CASE WHEN label_index = prediction THEN count ELSE 0 END AS tp FROM cm
  UNION ALL SELECT prediction, 0, count, 0 FROM cm
  UNION ALL SELECT * FROM (VALUES (CAST(0 AS DOUBLE), 0, 0, 0), (1.0, 0, 0, 0), (2.0, 0, 0, 0))
            v(class_index, actual, predicted, tp)),
c AS (SELECT class_index, CAST(sum(tp) AS BIGINT) AS true_positive, CAST(sum(actual) AS BIGINT) AS actual_total,
             CAST(sum(predicted) AS BIGINT) AS predicted_total FROM cells GROUP BY class_index),
m AS (SELECT *, CASE WHEN true_positive > 0 THEN CAST(true_positive AS DOUBLE) / predicted_total ELSE 0.0 END
                  AS precision,
                CASE WHEN true_positive > 0 THEN CAST(true_positive AS DOUBLE) / actual_total ELSE 0.0 END
                  AS recall FROM c),
mf AS (SELECT *, CASE WHEN true_positive > 0 THEN 2.0 * (precision * recall) / (precision + recall)
                      ELSE 0.0 END AS f1_score FROM m)
"""


def _with(src: str, body: str) -> str:
    return f"WITH src AS ({src}), {CM_SQL}, {COUNTS_SQL.strip()}\n{body.strip()}"


ALL = "SELECT * FROM scored"
ABSENT = "SELECT * FROM scored WHERE prediction <> 2"


@register("confusion_matrix", f"WITH src AS ({ALL}), {CM_SQL} SELECT * FROM cm", ("scored",))
def q_confusion_matrix(spark, sf):
    return V.confusion_matrix(scored(spark, sf))


@register("confusion_marginals", _with(ALL, "SELECT class_index, actual_total, predicted_total FROM c"),
          ("scored",))
def q_confusion_marginals(spark, sf):
    return V.confusion_marginals(scored(spark, sf))


@register("class_metrics", _with(ALL, "SELECT * FROM mf"), ("scored",))
def q_class_metrics(spark, sf):
    return V.class_metrics(scored(spark, sf))


@register("class_metrics_absent", _with(ABSENT, "SELECT * FROM mf"), ("scored",))
def q_class_metrics_absent(spark, sf):
    return V.class_metrics(scored(spark, sf).where(F.col("prediction") != 2))


@register("accuracy", f"""
WITH src AS ({ALL})
SELECT COALESCE(CAST(count(*) FILTER (WHERE label_index = prediction) AS DOUBLE) / NULLIF(count(*), 0), 0.0)
       AS accuracy FROM src
""", ("scored",))
def q_accuracy(spark, sf):
    return V.accuracy(scored(spark, sf))


MACRO_SQL = """
SELECT (COALESCE(max(CASE WHEN class_index = 0.0 THEN f1_score END), 0.0)
        + COALESCE(max(CASE WHEN class_index = 1.0 THEN f1_score END), 0.0)
        + COALESCE(max(CASE WHEN class_index = 2.0 THEN f1_score END), 0.0)) / 3.0 AS macro_f1 FROM mf
"""


@register("macro_f1", _with(ALL, MACRO_SQL), ("scored",))
def q_macro_f1(spark, sf):
    return V.macro_f1(scored(spark, sf))


@register("macro_f1_absent", _with(ABSENT, MACRO_SQL), ("scored",))
def q_macro_f1_absent(spark, sf):
    return V.macro_f1(scored(spark, sf).where(F.col("prediction") != 2))


def _record_sql(src: str) -> str:
    cols = []
    for i, name in enumerate(("positive", "negative", "neutral")):
        for metric, col in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score")):
            cols.append(f"max(CASE WHEN class_index = {float(i)} THEN {col} END) AS {name}_{metric}")
    return _with(src, f"""
SELECT (max(CASE WHEN class_index = 0.0 THEN f1_score END) + max(CASE WHEN class_index = 1.0 THEN f1_score END)
        + max(CASE WHEN class_index = 2.0 THEN f1_score END)) / 3.0 AS macro_f1, {", ".join(cols)},
       COALESCE(CAST(sum(true_positive) AS DOUBLE) / NULLIF(sum(actual_total), 0), 0.0) AS accuracy
FROM mf""")


@register("metrics_record", _record_sql(ALL), ("scored",))
def q_metrics_record(spark, sf):
    return V.metrics_record(scored(spark, sf))
