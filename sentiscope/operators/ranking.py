"""Exact per-group row index without a one-task-per-group window.

``row_number() OVER (PARTITION BY label ORDER BY u)`` sends a whole class to
one task; when one class holds most rows that task holds most of the data.
``group_rank`` computes the same 0-based index in two phases:

1. the order key ``u`` is a uniform hash fraction in [0, 1), so cutting it into
   ``S`` equal ranges (``bucket = floor(u * S)``) splits every class into ``S``
   sub-groups of about equal size *while keeping the order*;
2. counts per ``(group, bucket)`` (a small table: groups x S rows) give each
   sub-group its offset; a ``row_number`` inside each sub-group adds the local
   rank.

``S`` is chosen per group from its size so that a sub-group holds about
``rows_per_task`` rows; the index does not depend on ``S``.

``rank_cutoffs`` turns ranks into values of the order key, so that a caller can
compare wide rows with a per-group cut-off instead of sending them through the
window.  All of it is lazy: group sizes stay a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000


def group_counts(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("group_count"))


def with_group(df: DataFrame, per_group: DataFrame, group: str) -> DataFrame:
    """Attach a one-row-per-group table; a null group is a group like any other."""
    other = per_group.withColumnRenamed(group, "_g")
    return df.join(other, df[group].eqNullSafe(other["_g"])).drop("_g")


def group_rank(df: DataFrame, group: str, u: str, tie: str, out: str = "rank",
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``out`` = 0-based position of each row within ``group`` ordered by ``(u, tie)``; ``u`` in [0, 1)."""
    pieces = group_counts(df, group).select(
        group, F.ceil(F.col("group_count") / F.lit(rows_per_task)).cast("int").alias("_pieces"))
    piece = F.least(F.floor(F.col(u) * F.col("_pieces")), F.col("_pieces") - 1).cast("int")
    with_bucket = with_group(df, pieces, group).withColumn("_bucket", piece).drop("_pieces")
    # offsets: small table of (group, bucket) counts, cumulated per group
    sub = with_bucket.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sub.withColumn("_offset", F.coalesce(F.sum("_n").over(w_off), F.lit(0))).drop("_n")
    w_local = Window.partitionBy(group, "_bucket").orderBy(u, tie)
    local = with_bucket.withColumn("_local", F.row_number().over(w_local) - F.lit(1))
    offsets = offsets.withColumnRenamed(group, "_g").withColumnRenamed("_bucket", "_b")
    cond = local[group].eqNullSafe(offsets["_g"]) & (local["_bucket"] == offsets["_b"])
    return (local.join(offsets, cond, "inner")
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint"))
            .drop("_bucket", "_offset", "_local", "_g", "_b"))


def rank_cutoffs(df: DataFrame, ranks: DataFrame, group: str, u: str, tie: str, **at: str) -> DataFrame:
    """``group`` and, per ``name=column of ranks``, the order key ``(u, tie)`` of the row at that rank.

    Null where the group has no such row.  Only ``group, u, tie`` are ranked; compare
    with :func:`order_key`.  ``(u, tie)`` must differ from row to row of a group.
    """
    ranked = with_group(group_rank(df.select(group, u, tie), group, u, tie, out="_r"), ranks, group)
    cuts = [F.min(F.when(F.col("_r") == F.col(column), order_key(u, tie))).alias(name) for name, column in at.items()]
    return ranked.groupBy(group).agg(*cuts)


def order_key(u: str, tie: str) -> Column:
    return F.struct(F.col(u).alias("u"), F.col(tie).alias("tie"))
