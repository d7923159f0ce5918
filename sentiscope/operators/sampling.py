"""Exact, deterministic class resampling.

* ``undersample``: every class larger than the smallest keeps
  ``int((n_c + n_min) / 2)`` rows drawn without replacement; the smallest class
  is untouched.
* ``oversample``: every class smaller than the target (``ratio`` x the largest
  class) gains ``target - n_c`` rows drawn with replacement; originals are kept.

Draws are hashes, not ``rand``: the rows kept by ``undersample`` are the first
``k_c`` of the class in hash order, and draw ``j`` of class ``c`` in
``oversample`` picks the row at position ``floor(h(c, j) * n_c)``.  Only keys are
ranked (:mod:`sentiscope.operators.ranking`, no one-task-per-class window):
``undersample`` filters the wide rows by a per-class cut-off, and ``oversample``
aggregates the draws into per-row multiplicities before the wide rows join them,
so a row drawn many times is one join row.  Class sizes stay a DataFrame: any
number of classes, null among them.  ``key`` is unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiscope.functions.hashing import hash_fraction
from sentiscope.operators.ranking import group_counts, group_rank, order_key, rank_cutoffs, with_group

SLOTS_PER_TASK = 1_000_000


def undersample(df: DataFrame, label: str = "label", key: str = "doc_id", seed: int = 42) -> DataFrame:
    smallest = F.min("group_count").over(Window.partitionBy())  # over one row per class
    keep = group_counts(df, label).withColumn("_smallest", smallest).select(
        label, F.when(F.col("group_count") <= F.col("_smallest"), F.col("group_count"))
        .otherwise(F.floor((F.col("group_count") + F.col("_smallest")) / 2)).alias("_k"))
    drawn = df.withColumn("_u", hash_fraction(key, seed))
    cuts = rank_cutoffs(drawn, keep, label, "_u", key, _cut="_k")
    inside = F.col("_cut").isNull() | (order_key("_u", key) < F.col("_cut"))
    return with_group(drawn, cuts, label).where(inside).drop("_u", "_cut")


def oversample(df: DataFrame, label: str = "label", key: str = "doc_id", seed: int = 42,
               ratio: float = 1.0) -> DataFrame:
    """Originals plus draws with replacement; adds ``is_original``."""
    target = F.floor(F.max("group_count").over(Window.partitionBy()) * F.lit(float(ratio)))
    sizes = group_counts(df, label).withColumn("_extra", target - F.col("group_count")).where(F.col("_extra") > 0)
    # draw numbers in blocks, so that no task makes more than SLOTS_PER_TASK of them at a time
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("_extra") - 1) / SLOTS_PER_TASK)))
    blocks = sizes.select(label, "group_count", "_extra", block.alias("_block")).repartition(label, "_block")
    first = F.col("_block") * SLOTS_PER_TASK
    slots = blocks.select(label, "group_count", F.explode(
        F.sequence(first, F.least(first + SLOTS_PER_TASK, F.col("_extra")) - 1)).alias("_j"))
    draw_key = F.concat(F.coalesce(F.col(label).cast("string"), F.lit("null")), F.lit("#"), F.col("_j").cast("string"))
    picks = (slots.select(F.col(label).alias("_label"),
                          F.floor(hash_fraction(draw_key, seed) * F.col("group_count")).alias("_pick"))
             .groupBy("_label", "_pick").agg(F.count(F.lit(1)).alias("_m")))
    ranked = group_rank(df.select(label, key, hash_fraction(key, seed).alias("_u")), label, "_u", key, out="_r")
    same = ranked[label].eqNullSafe(picks["_label"]) & (ranked["_r"] == picks["_pick"])
    times = ranked.join(picks, same).select(F.col(key).alias("_key"), "_m")
    drawn = (df.join(times, df[key].eqNullSafe(times["_key"]))
             .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_m").cast("int"))))
             .drop("_key", "_m", "_copy").withColumn("is_original", F.lit(False)))
    return df.withColumn("is_original", F.lit(True)).unionByName(drawn)
