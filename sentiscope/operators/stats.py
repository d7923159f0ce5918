"""Distributed order statistics over value counts.

``value_counts`` reduces a column to ``value, n`` rows (partial sums before the shuffle; counts
of several batches are merged by summing them again).  ``median_of_counts`` finds the exact median of
such rows in one lazy plan: every value has a 32-bit place between the least and the
greatest, and the middle ranks are followed down two digits of 16 bits - each level counts
the values of the digit before in 65 536 bins, a table of at most that many rows.  Only values that share all
32 bits are ordered.  Nothing is gathered, and no job runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16
LEVELS = 2


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``value, n``: the rows per distinct value; null is a value (for the total), NaN counts as null."""
    v = F.col(col).cast("double")
    return (df.select(F.when(~F.isnan(v), v).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")))


def merge_counts(counts: DataFrame) -> DataFrame:
    """Value counts of several batches as one."""
    return counts.groupBy("value").agg(F.sum("n").alias("n"))


def _holding(bins: DataFrame, within: list[str], digit: str) -> DataFrame:
    """The bins that hold a rank: ``within, digit``, and the ranks (``lower``, ``upper``) inside them, null where it is not there."""
    upto = F.sum("n").over(Window.partitionBy(*within).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0))
    counted = bins.withColumn("before", upto - F.col("n"))
    inside = [F.when((F.col(r) > F.col("before")) & (F.col(r) <= F.col("before") + F.col("n")), F.col(r) - F.col("before")).alias(r)
              for r in ("lower", "upper")]
    return counted.select(*within, digit, *inside).where("lower is not null or upper is not null")


def median_of_counts(counts: DataFrame) -> Column:
    """The exact (interpolated) median of ``value, n`` rows, each finite value once, as a scalar column; null without values."""
    known = counts.where(F.col("value").isNotNull())
    ends = known.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"))).scalar()
    half = (ends["high"] / 2 - ends["low"] / 2)
    place = F.when(half > 0, F.floor((F.col("value") / 2 - ends["low"] / 2) / half * F.lit(float(1 << DIGIT * LEVELS))))
    place = F.least(F.coalesce(place.cast("long"), F.lit(0)), F.lit((1 << DIGIT * LEVELS) - 1))
    digits = [F.shiftright("place", DIGIT * (LEVELS - 1 - i)).bitwiseAND(F.lit((1 << DIGIT) - 1)).alias(f"d{i}") for i in range(LEVELS)]
    places = known.withColumn("place", place).select("value", "n", *digits)
    ranks = (F.floor((ends["n"] + 1) / 2).alias("lower"), (F.floor(ends["n"] / 2) + 1).alias("upper"))
    chosen = None
    for i in range(LEVELS):
        within = [f"d{j}" for j in range(i)]
        # at most two bins are chosen, so the join with them is broadcast
        rows = places.select("*", *ranks) if chosen is None else places.join(F.broadcast(chosen), within)
        bins = rows.groupBy(*within, "lower", "upper", f"d{i}").agg(F.sum("n").alias("n"))
        chosen = _holding(bins, within, f"d{i}")
    every = [f"d{j}" for j in range(LEVELS)]
    hits = _holding(places.join(F.broadcast(chosen), every), every, "value")  # orders the values that share a place
    return hits.agg((F.min(F.when(F.col("lower").isNotNull(), F.col("value"))) / 2
                     + F.min(F.when(F.col("upper").isNotNull(), F.col("value"))) / 2)).scalar()


def exact_median(df: DataFrame, col: str) -> float | None:
    """Exact (interpolated) median of the values of ``col`` that are neither null nor NaN."""
    return df.sparkSession.range(1).select(median_of_counts(value_counts(df, col))).first()[0]


def approx_median(df: DataFrame, col: str, accuracy: int = 10_000):
    """Bounded-memory approximate median for dashboards on very large stores."""
    return df.agg(F.percentile_approx(col, 0.5, accuracy).alias("median"))
