"""Batch preparation: validate, quarantine, label, split, weight.

All operators are ``DataFrame -> DataFrame`` and deterministic: the split is a
hash of the row key (not ``rand``), so it does not change when the input is
repartitioned, and train / val / test are disjoint by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentiscope.functions.hashing import hash_fraction
from sentiscope.functions.labels import score_to_label, score_to_label_or_unknown
from sentiscope.operators.ranking import group_counts, order_key, rank_cutoffs, with_group

# Fixed values of the original preparation.
TRAIN_RATIO, VAL_RATIO, TEST_RATIO = 0.8, 0.1, 0.1
RANDOM_SEED = 42
SCORE_PATTERN = "^[1-5]$"
SAMPLE_ROWS = 10_000


def load_reviews(raw: DataFrame, text: str = "Text", score: str = "Score") -> DataFrame:
    """Projection of the two used columns, rows with any null dropped."""
    return raw.select(text, score).na.drop("any")


def valid_score(score="Score") -> Column:
    s = F.trim(F.col(score) if isinstance(score, str) else score)
    return s.rlike(SCORE_PATTERN)


def clean_reviews(raw: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Trim, regex-validate and cast the score; null text / score dropped.

    Output ``keep..., text, score int``.  Rows failing validation are available
    from :func:`quarantine`.
    """
    keep = [c for c in keep if c in raw.columns]
    trimmed = raw.select(*keep, F.col("Text").alias("text"), F.trim(F.col("Score")).alias("score"))
    return (trimmed.na.drop(subset=["text", "score"])
            .where(F.col("score").rlike(SCORE_PATTERN))
            .withColumn("score", F.col("score").cast("int")))


def label_reviews(clean: DataFrame, score: str = "score") -> DataFrame:
    return clean.withColumn("label", score_to_label(score))


def label_with_unknown(frame: DataFrame, score: str = "score") -> DataFrame:
    return frame.withColumn("label", score_to_label_or_unknown(score))


def coerce_score(col="Score") -> Column:
    """Lenient numeric parse: anything that is not a number becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("double")


def quarantine(raw: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Rows with text whose score is missing or not a number, with the reason."""
    keep = [c for c in keep if c in raw.columns]
    num = coerce_score(F.trim(F.col("Score")))
    return (raw.where(F.col("Text").isNotNull() & num.isNull())
            .select(*keep, "Score",
                    F.when(F.col("Score").isNull(), F.lit("missing_score"))
                     .otherwise(F.lit("non_numeric_score")).alias("reason")))


def truncated_score(col="score") -> Column:
    """Lenient numeric parse cut to its whole part (5.5 is 5, 0.5 is 0); null where it is no number or too large."""
    c = F.col(col) if isinstance(col, str) else col
    return coerce_score(F.trim(c.cast("string"))).try_cast("int")


def valid_range(frame: DataFrame, score: str = "score") -> DataFrame:
    """Rows whose (truncated) score is 1 to 5."""
    return frame.where(F.col(score).between(1, 5))


def sample_head(frame: DataFrame, n: int = SAMPLE_ROWS, order: str = "doc_id") -> DataFrame:
    """First ``n`` rows in a defined order (nulls first).

    The keys alone are ordered for the last one of the sample, and the wide rows are compared with it: no task merges the
    texts of the first ``n`` rows of every other.  Of the rows of that last key as many are taken as are left.
    """
    keys = frame.select(F.struct(F.col(order).alias("key")).alias("at")).orderBy("at").limit(n)
    last = keys.groupBy("at").agg(F.count(F.lit(1)).alias("n")).agg(F.max("at").alias("at"), F.max_by("n", "at").alias("n")).first()
    if last["at"] is None:
        return frame.limit(0)
    key, cut = F.col(order), last["at"]["key"]
    below, ties = (F.lit(False), key.isNull()) if cut is None else (key.isNull() | (key < F.lit(cut)), key == F.lit(cut))
    return frame.where(below).unionByName(frame.where(ties).limit(last["n"])).orderBy(order)


def resume_from(frame: DataFrame, start: int, index: str = "row_index") -> DataFrame:
    """Rows at or after a row position (empty when ``start`` is past the end)."""
    return frame.where(F.col(index) >= F.lit(start))


# ------------------------------------------------------------------ splits
def split_column(key="doc_id", seed: int = RANDOM_SEED, train: float = TRAIN_RATIO,
                 val: float = VAL_RATIO) -> Column:
    u = hash_fraction(key, seed)
    return (F.when(u < F.lit(train), F.lit("train"))
            .when(u < F.lit(train + val), F.lit("val")).otherwise(F.lit("test")))


def split_random(frame: DataFrame, key: str = "doc_id", seed: int = RANDOM_SEED) -> DataFrame:
    """80/10/10 split as a column (half-open ranges of the hash fraction)."""
    return frame.withColumn("split", split_column(key, seed))


def split_frames(frame: DataFrame, key: str = "doc_id", seed: int = RANDOM_SEED):
    s = split_random(frame, key, seed)
    return tuple(s.where(F.col("split") == name).drop("split") for name in ("train", "val", "test"))


def split_stratified(frame: DataFrame, label: str = "label", key: str = "doc_id",
                     seed: int = RANDOM_SEED, train_pct: int = 80, val_pct_of_rest: int = 50) -> DataFrame:
    """Per-class exact 80 / 20 split, then the 20 split 50 / 50 into val / test.

    Within a class rows are ordered by the hash fraction of ``key`` (unique); the first
    ``round(n_c * 0.8)`` are train, the next ``round(rest * 0.5)`` val, the remainder
    test (integer half-up rounding).  Keys alone are ranked, without a one-task-per-class
    window; the wide rows are compared with their class's two cut-offs.
    """
    n_train = F.floor((F.col("group_count") * train_pct + 50) / 100)
    n_val = F.floor(((F.col("group_count") - n_train) * val_pct_of_rest + 50) / 100)
    ends = group_counts(frame, label).select(label, n_train.alias("_val"), (n_train + n_val).alias("_test"))
    drawn = frame.withColumn("_u", hash_fraction(key, seed))
    cuts = rank_cutoffs(drawn, ends, label, "_u", key, _val_cut="_val", _test_cut="_test")
    at = order_key("_u", key)
    split = (F.when(F.col("_val_cut").isNull() | (at < F.col("_val_cut")), F.lit("train"))
             .when(F.col("_test_cut").isNull() | (at < F.col("_test_cut")), F.lit("val"))
             .otherwise(F.lit("test")))
    return with_group(drawn, cuts, label).withColumn("split", split).drop("_u", "_val_cut", "_test_cut")


# ----------------------------------------------------------------- weights
def class_weight_table(train: DataFrame, label: str = "label") -> DataFrame:
    """``label, count, class_weight`` with weight ``N / (k * n_c)`` from train only."""
    counts = group_counts(train, label).withColumnRenamed("group_count", "count")
    # the window runs over the aggregated table (one row per class)
    everything = Window.partitionBy()
    total = F.sum("count").over(everything).cast("double")
    k = F.count(F.lit(1)).over(everything)
    return counts.select(label, "count", (total / (k * F.col("count"))).alias("class_weight"))


def add_class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Attach ``class_weight`` to every training row.

    The weight table has one row per class; the planner broadcasts it when it is small.
    """
    weights = class_weight_table(train, label).select(label, "class_weight")
    return train.join(weights, label, "left")


def unit_weights(frame: DataFrame) -> DataFrame:
    return frame.withColumn("class_weight", F.lit(1.0))
