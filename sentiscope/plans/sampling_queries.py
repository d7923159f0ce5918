"""Registered resampling queries over the training split of ``labelled``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.catalog import register
from sentiscope.functions.hashing import hash_fraction_sql
from sentiscope.operators import prepare as P
from sentiscope.operators import sampling as S
from sentiscope.plans.train import RESAMPLING, resampled
from sentiscope.sources.fixtures import labelled

U = hash_fraction_sql("doc_id", 42)
SPLIT = f"CASE WHEN {U} < 0.8 THEN 'train' WHEN {U} < 0.8 + 0.1 THEN 'val' ELSE 'test' END"
TRAIN_SQL = f"train AS (SELECT doc_id, label FROM labelled WHERE {SPLIT} = 'train')"
RANKED_SQL = f"""r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {U}, doc_id) - 1 AS rk,
                 count(*) OVER (PARTITION BY label) AS n FROM train)"""


def _oversample_sql(ratio: float) -> str:
    slot_u = hash_fraction_sql("label || '#' || CAST(j AS VARCHAR)", 42)
    return f"""
WITH {TRAIN_SQL}, {RANKED_SQL},
c AS (SELECT DISTINCT label, n FROM r),
t AS (SELECT label, n, GREATEST(0, CAST(floor({ratio} * (SELECT max(n) FROM c)) AS BIGINT) - n) AS extra FROM c),
slots AS (SELECT label, n, unnest(range(extra)) AS j FROM t),
picks AS (SELECT label, CAST(floor({slot_u} * n) AS BIGINT) AS rk FROM slots)
SELECT doc_id, label, true AS is_original FROM train
UNION ALL
SELECT r.doc_id, r.label, false FROM picks p JOIN r ON p.label = r.label AND p.rk = r.rk
"""


def _train(spark, sf):
    train, _, _ = P.split_frames(labelled(spark, sf))
    return train.select("doc_id", "label")


@register("undersample", f"""
WITH {TRAIN_SQL}, {RANKED_SQL}, m AS (SELECT min(n) AS mn FROM r)
SELECT doc_id, label FROM r, m WHERE n <= mn OR rk < floor((n + mn) / 2)
""", ("labelled",))
def q_undersample(spark, sf):
    return S.undersample(_train(spark, sf))


@register("oversample", _oversample_sql(1.0), ("labelled",))
def q_oversample(spark, sf):
    return S.oversample(_train(spark, sf)).select("doc_id", "label", "is_original")


@register("oversample_75", _oversample_sql(0.75), ("labelled",))
def q_oversample_75(spark, sf):
    return S.oversample(_train(spark, sf), ratio=0.75).select("doc_id", "label", "is_original")


@register("resampled_class_sizes", f"""
WITH {TRAIN_SQL}, {RANKED_SQL}, m AS (SELECT min(n) AS mn, max(n) AS mx FROM r),
c AS (SELECT DISTINCT label, n FROM r)
SELECT label, n AS original, CAST(CASE WHEN n <= mn THEN n ELSE floor((n + mn) / 2) END AS BIGINT) AS undersampled,
       CAST(GREATEST(n, mx) AS BIGINT) AS oversampled
FROM c, m
""", ("labelled",))
def q_resampled_class_sizes(spark, sf):
    train = _train(spark, sf)
    orig = train.groupBy("label").agg(F.count(F.lit(1)).alias("original"))
    under = S.undersample(train).groupBy("label").agg(F.count(F.lit(1)).alias("undersampled"))
    over = S.oversample(train).groupBy("label").agg(F.count(F.lit(1)).alias("oversampled"))
    return orig.join(under, "label").join(over, "label")


@register("resampled_class_weights", f"""
WITH c AS (SELECT label, count(*) AS n FROM labelled WHERE {SPLIT} = 'train' AND text IS NOT NULL GROUP BY label),
x AS (SELECT label, n, max(n) OVER () AS mx, min(n) OVER () AS mn FROM c),
s AS (SELECT 'none' AS resampling, label, n AS size FROM x
      UNION ALL SELECT 'oversample', label, mx FROM x
      UNION ALL SELECT 'oversample_75', label, GREATEST(n, CAST(floor(0.75 * mx) AS BIGINT)) FROM x
      UNION ALL SELECT 'undersample', label, CASE WHEN n <= mn THEN n ELSE CAST(floor((n + mn) / 2) AS BIGINT) END FROM x)
SELECT resampling, label, size AS "count",
       round(CAST(sum(size) OVER w AS DOUBLE) / (count(*) OVER w * size), 9) AS class_weight
FROM s WINDOW w AS (PARTITION BY resampling)
""", ("labelled",))
def q_resampled_class_weights(spark, sf):
    """The class weights that a fit gets after each way of resampling its training split."""
    train, _, _ = P.split_frames(labelled(spark, sf))
    return reduce(DataFrame.unionByName, [
        P.class_weight_table(resampled(train, how)).select(
            F.lit(how).alias("resampling"), "label", "count", F.round("class_weight", 9).alias("class_weight"))
        for how in RESAMPLING])
