"""Monitoring analytics over the prediction store.

Every operator takes the store (or the analytics frame derived from it) and
returns a DataFrame; nothing is pulled to the driver except one-row KPI values
where the caller asks for Python scalars.  Semantics kept from the original
dashboard:

* filters and the row limit of the latest-N table apply only to that table (and
  to the suspicious sample drawn from it); distributions and KPIs read the whole
  store of one source;
* null group keys are dropped before grouping (pandas ``value_counts`` /
  ``groupby`` / ``crosstab`` semantics);
* the confidence histogram is right-closed with the lowest edge included and keeps
  empty bins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentiscope.functions.labels import UNKNOWN
from sentiscope.functions.probability import confidence, percent, probability_values
from sentiscope.operators.stats import median_of_counts, merge_counts, value_counts
from sentiscope.sources.fixtures import STREAM_SOURCE

# Fixed values of the dashboard.
ALL = "All"
LOW_CONFIDENCE_THRESHOLD = 0.60
DEFAULT_LIMIT = 1000
SAMPLE_ROWS = 50
SENTIMENTS = ("negative", "neutral", "positive")
# Histogram edges and the interval labels pandas prints for them
# (right-closed, lowest edge included).
CONFIDENCE_EDGES = (0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
CONFIDENCE_LABELS = ("(-0.001, 0.5]", "(0.5, 0.6]", "(0.6, 0.7]", "(0.7, 0.8]",
                     "(0.8, 0.9]", "(0.9, 1.0]")



def latest_order():
    """Newest first; ties broken by the store id."""
    return (F.col("processed_at").desc_nulls_last(), F.col("event_id").desc_nulls_last())


# ------------------------------------------------------------------ scans
def prepare(frame: DataFrame) -> DataFrame:
    """Add ``confidence`` and ``probability_values``; coerce ``processed_at``."""
    return frame.withColumns({
        "confidence": confidence("probability"),
        "probability_values": probability_values("probability"),
        "processed_at": F.col("processed_at").cast("timestamp_ntz"),
    })


def analytics_scan(store: DataFrame, source: str = STREAM_SOURCE) -> DataFrame:
    """Source filter + the analytics projection (no text), prepared."""
    cols = ["event_id", "score", "predicted_label", "probability", "batch_id", "processed_at", "source"]
    frame = store.where(F.col("source") == F.lit(source)).select(*cols)
    return prepare(frame)


def build_filter(source: str = STREAM_SOURCE, sentiment=ALL, score=ALL, batch=ALL) -> Column:
    """Conjunction of the fixed source and the optional sentiment / score / batch filters."""
    preds = [F.col("source") == F.lit(source)]
    if sentiment != ALL:
        preds.append(F.col("predicted_label") == F.lit(sentiment))
    if score != ALL:
        preds.append(F.col("score") == F.lit(int(score)))
    if batch != ALL:
        preds.append(F.col("batch_id") == F.lit(int(batch)))
    return reduce(lambda a, b: a & b, preds)


def filter_predictions(store: DataFrame, source: str = STREAM_SOURCE, sentiment=ALL,
                       score=ALL, batch=ALL) -> DataFrame:
    return store.where(build_filter(source, sentiment, score, batch))


def latest_predictions(store: DataFrame, source: str = STREAM_SOURCE, sentiment=ALL, score=ALL,
                       batch=ALL, limit: int = DEFAULT_LIMIT, keys_from: DataFrame | None = None) -> DataFrame:
    """Latest ``limit`` filtered store rows, newest first (ties by ``event_id``).

    Lazy, in two steps so the wide columns (``text``) are read for few rows only: a
    subquery finds the ``limit``-th newest time on that column alone (``TakeOrderedAndProject``: each task
    keeps its own newest), and its result is a lower bound that the wide Parquet scan gets as a pushed filter (row
    groups older than it are skipped by their statistics).  A null time is the oldest; where
    the newest rows do not fill the limit with times there is no lower bound.
    """
    filtered = filter_predictions(store, source, sentiment, score, batch)
    # ``keys_from``: the same rows without the wide columns (e.g. a store view that
    # skips the text lookup); defaults to the store itself, where column pruning
    # already keeps the first step narrow
    narrow = filter_predictions(keys_from, source, sentiment, score, batch) if keys_from is not None else filtered
    at = F.col("processed_at")
    newest = narrow.select("processed_at").orderBy(at.desc_nulls_last()).limit(limit)
    bound = newest.agg(F.when(F.count("processed_at") == limit, F.min("processed_at"))).scalar()
    earliest = F.lit("0001-01-01 00:00:00").cast(narrow.schema["processed_at"].dataType)
    rows = filtered.where((at >= F.coalesce(bound, earliest)) | at.isNull())
    return prepare(rows).select(
        "event_id", "processed_at", "text_preview", "text", "score", "prediction",
        "predicted_label", "probability_values",
        percent("confidence").alias("confidence_pct"), "batch_id", "source").orderBy(*latest_order()).limit(limit)


# ------------------------------------------------------------ predicates
def low_confidence(frame: DataFrame, threshold: float = LOW_CONFIDENCE_THRESHOLD) -> DataFrame:
    """Rows whose confidence is strictly below the threshold (null excluded)."""
    return frame.where(F.col("confidence") < F.lit(threshold))


def suspicious_condition() -> Column:
    s, p = F.col("score"), F.col("predicted_label")
    return (((s == 5) & (p == "negative")) | ((s == 1) & (p == "positive"))
            | (s.isin(4, 5) & (p == "neutral")))


def suspicious(frame: DataFrame) -> DataFrame:
    """Rating and predicted sentiment disagree strongly."""
    return frame.where(suspicious_condition())


# ----------------------------------------------------------- aggregates
def sentiment_summary(frame: DataFrame) -> DataFrame:
    """Count and percentage (2 dp) per predicted sentiment, count descending."""
    counts = (frame.where(F.col("predicted_label").isNotNull())
              .groupBy(F.col("predicted_label").alias("sentiment"))
              .agg(F.count(F.lit(1)).alias("count")))
    # the window runs over the aggregated rows (one per sentiment), not the store
    total = F.sum("count").over(Window.partitionBy())
    return (counts.withColumn("percentage", F.round(F.col("count") / total * F.lit(100.0), 2))
            .orderBy(F.col("count").desc(), "sentiment"))


def score_distribution(frame: DataFrame) -> DataFrame:
    return (frame.where(F.col("score").isNotNull()).groupBy("score")
            .agg(F.count(F.lit(1)).alias("count")).orderBy("score"))


def confidence_by_sentiment(frame: DataFrame) -> DataFrame:
    return (frame.where(F.col("predicted_label").isNotNull()).groupBy("predicted_label")
            .agg(percent(F.avg("confidence")).alias("average_confidence"))
            .orderBy("predicted_label"))


def batch_summary(frame: DataFrame) -> DataFrame:
    """Records per micro-batch, newest batch first."""
    return (frame.where(F.col("batch_id").isNotNull()).groupBy("batch_id")
            .agg(F.count(F.lit(1)).alias("records")).orderBy(F.col("batch_id").desc()))


def batch_kpis(batches: DataFrame) -> DataFrame:
    """One row of batch KPIs over ``batch_summary``; zeros (null latest id) when empty."""
    return batches.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.avg("records"), F.lit(0.0)).cast("double").alias("avg_records_per_batch"),
        F.coalesce(F.min("records"), F.lit(0)).cast("bigint").alias("min_records_per_batch"),
        F.coalesce(F.max("records"), F.lit(0)).cast("bigint").alias("max_records_per_batch"),
        F.max("batch_id").alias("latest_batch_id"),
    )


def confidence_bin(conf: Column) -> Column:
    """0-based histogram bin of a confidence; null outside [0, 1]."""
    expr = None
    for i, hi in enumerate(CONFIDENCE_EDGES[1:]):
        cond = conf <= F.lit(hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.when(conf < F.lit(CONFIDENCE_EDGES[0]), F.lit(None).cast("int")).otherwise(expr)


def confidence_histogram(frame: DataFrame) -> DataFrame:
    """Six fixed bins, empty bins kept, in bin order.

    One pass of conditional counts (a single partial aggregate per task), then
    ``stack`` turns the one-row result into the six bin rows - no join with a
    bin table is needed to keep empty bins.
    """
    b = confidence_bin(F.col("confidence"))
    counts = frame.agg(*[F.count_if(b == F.lit(i)).alias(f"c{i}") for i in range(len(CONFIDENCE_LABELS))])
    parts = ", ".join(f"{i}, '{label}', c{i}" for i, label in enumerate(CONFIDENCE_LABELS))
    return (counts.selectExpr(f"stack({len(CONFIDENCE_LABELS)}, {parts}) AS (bin, confidence_range, count)")
            .select(F.col("bin").cast("int"), "confidence_range", F.col("count").cast("bigint"))
            .orderBy("bin"))


# Grouping sets of the fused dashboard scan, by name.
DASHBOARD_SETS = (("sentiment", ("predicted_label",)), ("score", ("score",)),
                  ("batch", ("batch_id",)), ("score_sentiment", ("score", "predicted_label")))


def dashboard_counts(frame: DataFrame) -> DataFrame:
    """Sentiment, score, batch and score x sentiment counts in ONE scan and ONE shuffle.

    ``GROUPING SETS`` replaces four separate aggregations over the store.  A row
    of a set is dropped when one of that set's own keys is null (the per-chart
    null-key rule); ``grouping_id`` tells a data null from an absent key.
    """
    dims = ["predicted_label", "score", "batch_id"]
    sets = [list(cols) for _, cols in DASHBOARD_SETS]
    agg = frame.groupingSets(sets, *dims).agg(F.count(F.lit(1)).alias("count"),
                                              F.grouping_id().alias("_gid"))
    name = None
    keep = None
    for set_name, cols in DASHBOARD_SETS:
        gid = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in cols)
        cond = F.col("_gid") == F.lit(gid)
        name = F.when(cond, F.lit(set_name)) if name is None else name.when(cond, F.lit(set_name))
        nn = cond
        for c in cols:
            nn = nn & F.col(c).isNotNull()
        keep = nn if keep is None else keep | nn
    return agg.where(keep).select(name.alias("grouping"), *dims, "count")


def score_by_sentiment(frame: DataFrame) -> DataFrame:
    return (frame.where(F.col("score").isNotNull() & F.col("predicted_label").isNotNull())
            .groupBy("score", "predicted_label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("score", "predicted_label"))


def score_sentiment_crosstab(frame: DataFrame, sentiments=(*SENTIMENTS, UNKNOWN)) -> DataFrame:
    """Wide score x sentiment counts, zeros filled: a column per named label, and ``other`` for all further ones."""
    label = F.when(F.col("predicted_label").isin(*sentiments), F.col("predicted_label")).otherwise(F.lit("other"))
    return (frame.where(F.col("score").isNotNull() & F.col("predicted_label").isNotNull())
            .select("score", label.alias("label")).groupBy("score").pivot("label", [*sentiments, "other"])
            .agg(F.count(F.lit(1))).na.fill(0).orderBy("score"))


def confidence_totals(counts: DataFrame) -> DataFrame:
    """One row ``total, average, median, least, greatest, low`` from the value counts of the confidence (null among them)."""
    v, n = F.col("value"), F.col("n")
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                     (F.sum(v * n) / F.sum(F.when(v.isNotNull(), n))).alias("average"),
                     F.min("value").alias("least"), F.max("value").alias("greatest"),
                     F.coalesce(F.sum(F.when(v < F.lit(LOW_CONFIDENCE_THRESHOLD), n)), F.lit(0)).alias("low"))
    return row.withColumn("median", median_of_counts(counts))


def confidence_stats(frame: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Mean / exact median / min / max confidence as percentages (2 dp) + low-confidence count.

    Everything comes from the value counts of the confidence (``value, n``): one scan
    of the store, or none if ``counts`` are given (for instance merged from the batches' rollups).
    """
    totals = confidence_totals(merge_counts(counts) if counts is not None else value_counts(frame, "confidence"))
    return totals.select(percent("average").alias("average_confidence"), percent("median").alias("median_confidence"),
                         percent("least").alias("min_confidence"), percent("greatest").alias("max_confidence"),
                         F.col("low").cast("bigint").alias("low_confidence_count"))


def confidence_stats_approx(frame: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """One-pass variant of :func:`confidence_stats` for very large stores: the median is
    ``percentile_approx`` (bounded memory per task, rank error <= n / accuracy)."""
    conf = F.col("confidence")
    return frame.agg(
        percent(F.avg(conf)).alias("average_confidence"),
        percent(F.percentile_approx(conf, 0.5, accuracy)).alias("median_confidence"),
        percent(F.min(conf)).alias("min_confidence"),
        percent(F.max(conf)).alias("max_confidence"),
        F.count_if(conf < F.lit(LOW_CONFIDENCE_THRESHOLD)).alias("low_confidence_count"),
    )


def available_batches(frame: DataFrame) -> DataFrame:
    return (frame.select("batch_id").where(F.col("batch_id").isNotNull())
            .distinct().orderBy("batch_id"))


def count_by_source(store: DataFrame) -> DataFrame:
    return store.groupBy("source").agg(F.count(F.lit(1)).alias("count")).orderBy("source")


def status_kpis(frame: DataFrame) -> DataFrame:
    """Header KPIs in one pass: totals, latest batch, mean confidence, class counters."""
    p = F.col("predicted_label")
    return frame.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.max("batch_id").alias("latest_batch_id"),
        percent(F.avg("confidence")).alias("average_confidence"),
        F.count_if(p == "positive").alias("positive_count"),
        F.count_if(p == "negative").alias("negative_count"),
        F.count_if(p == "neutral").alias("neutral_count"),
        F.count_if(F.col("confidence") < F.lit(LOW_CONFIDENCE_THRESHOLD)).alias("low_confidence_count"),
    )


def sentiment_kpis(frame: DataFrame) -> DataFrame:
    """Sentiment -> count lookup with a zero default for absent classes."""
    return status_kpis(frame).select("positive_count", "negative_count", "neutral_count")


# ------------------------------------------------------------ samples
def low_confidence_sample(frame: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """Newest ``n`` low-confidence rows (the order is ours: newest first, then id)."""
    return (low_confidence(frame).orderBy(*latest_order()).limit(n)
            .select("event_id", "processed_at", "score", "predicted_label",
                    percent("confidence").alias("confidence_pct"), "batch_id"))


def suspicious_sample(store: DataFrame, source: str = STREAM_SOURCE, sentiment=ALL, score=ALL,
                      batch=ALL, limit: int = DEFAULT_LIMIT, n: int = SAMPLE_ROWS,
                      keys_from: DataFrame | None = None) -> DataFrame:
    """Suspicious rows among the latest ``limit`` filtered rows, first ``n`` newest."""
    latest = latest_predictions(store, source, sentiment, score, batch, limit, keys_from=keys_from)
    return (suspicious(latest).orderBy(*latest_order()).limit(n)
            .select("event_id", "processed_at", "text_preview", "score", "predicted_label",
                    "confidence_pct", "batch_id"))


def latest_batches(frame: DataFrame, n: int = 10) -> DataFrame:
    return batch_summary(frame).orderBy(F.col("batch_id").desc()).limit(n)


def batch_series(frame: DataFrame) -> DataFrame:
    return batch_summary(frame).orderBy("batch_id")


# ------------------------------------------------------------- store ops
def purge_source(store: DataFrame, source: str) -> DataFrame:
    """Rows surviving a delete-by-source (rows without a source survive)."""
    return store.where(~F.col("source").eqNullSafe(F.lit(source)))


def coerce_timestamp(col) -> Column:
    """Lenient timestamp parse: malformed strings become null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)
