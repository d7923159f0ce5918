"""Registered monitoring queries over the prediction store (+ DuckDB oracles)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.catalog import register
from sentiscope.functions.probability import confidence, probability_values
from sentiscope.operators import monitor as M
from sentiscope.plans.report import report_summary
from sentiscope.sources.fixtures import STREAM_SOURCE, TEST_SOURCE, predictions

# The analytics frame in DuckDB: source filter + projection + derived confidence.
ANALYTICS_CTE = f"""
WITH analytics AS (
  SELECT event_id, score, predicted_label, probability, batch_id, processed_at, source,
         list_max(probability) AS confidence,
         COALESCE(array_to_string(list_transform(probability, lambda x: printf('%.4f', x)), ' | '), '')
           AS probability_values
  FROM predictions WHERE source = '{STREAM_SOURCE}')
"""

# Filters used by the registered latest-N / filter queries.
FILTER_SENTIMENT, FILTER_SCORE = "positive", 4


def _analytics(spark, sf):
    return M.analytics_scan(predictions(spark, sf, with_text=False))


def _sql(body: str) -> str:
    return ANALYTICS_CTE.strip() + "\n" + body.strip()


@register("sentiment_summary", _sql("""
SELECT predicted_label AS sentiment, count(*) AS count,
       round(count(*) / sum(count(*)) OVER () * 100.0, 2) AS percentage
FROM analytics WHERE predicted_label IS NOT NULL GROUP BY predicted_label
"""), ("predictions",))
def q_sentiment_summary(spark, sf):
    return M.sentiment_summary(_analytics(spark, sf))


@register("analytics_scan", _sql("""
SELECT event_id, score, predicted_label, confidence, probability_values, batch_id, processed_at, source
FROM analytics
"""), ("predictions",))
def q_analytics_scan(spark, sf):
    return _analytics(spark, sf).select(
        "event_id", "score", "predicted_label", "confidence", "probability_values",
        "batch_id", "processed_at", "source")


@register("prepare_predictions", """
SELECT event_id, list_max(probability) AS confidence,
       COALESCE(array_to_string(list_transform(probability, lambda x: printf('%.4f', x)), ' | '), '')
         AS probability_values,
       processed_at
FROM predictions
""", ("predictions",))
def q_prepare_predictions(spark, sf):
    return M.prepare(predictions(spark, sf, with_text=False)).select(
        "event_id", "confidence", "probability_values", "processed_at")


@register("confidence", """
SELECT event_id, list_max(probability) AS confidence FROM predictions
""", ("predictions",))
def q_confidence(spark, sf):
    return predictions(spark, sf, with_text=False).select("event_id", confidence("probability").alias("confidence"))


@register("probability_values", """
SELECT event_id,
       COALESCE(array_to_string(list_transform(probability, lambda x: printf('%.4f', x)), ' | '), '')
         AS probability_values
FROM predictions
""", ("predictions",))
def q_probability_values(spark, sf):
    return predictions(spark, sf, with_text=False).select(
        "event_id", probability_values("probability").alias("probability_values"))


@register("text_preview", """
SELECT event_id, SUBSTRING(text, 1, 120) AS text_preview, SUBSTRING(text, 1, 90) AS report_preview
FROM predictions
""", ("predictions",))
def q_text_preview(spark, sf):
    return predictions(spark, sf).select(
        "event_id", F.substring("text", 1, 120).alias("text_preview"),
        F.substring("text", 1, 90).alias("report_preview"))


@register("latest_predictions", f"""
SELECT event_id, processed_at, text_preview, text, score, prediction, predicted_label,
       COALESCE(array_to_string(list_transform(probability, lambda x: printf('%.4f', x)), ' | '), '')
         AS probability_values,
       round(list_max(probability) * 100.0, 2) AS confidence_pct, batch_id, source
FROM predictions WHERE source = '{STREAM_SOURCE}'
ORDER BY processed_at DESC NULLS LAST, event_id DESC NULLS LAST LIMIT {M.DEFAULT_LIMIT}
""", ("predictions",))
def q_latest_predictions(spark, sf):
    return M.latest_predictions(predictions(spark, sf), keys_from=predictions(spark, sf, with_text=False))


@register("filter_predictions", f"""
SELECT event_id, score, predicted_label, batch_id, source FROM predictions
WHERE source = '{STREAM_SOURCE}' AND predicted_label = '{FILTER_SENTIMENT}' AND score = {FILTER_SCORE}
""", ("predictions",))
def q_filter_predictions(spark, sf):
    return M.filter_predictions(predictions(spark, sf, with_text=False), sentiment=FILTER_SENTIMENT,
                                score=FILTER_SCORE).select(
        "event_id", "score", "predicted_label", "batch_id", "source")


@register("latest_filtered", f"""
SELECT event_id, processed_at, score, predicted_label, batch_id FROM predictions
WHERE source = '{STREAM_SOURCE}' AND predicted_label = 'negative' AND batch_id = 7
ORDER BY processed_at DESC NULLS LAST, event_id DESC NULLS LAST LIMIT 5
""", ("predictions",))
def q_latest_filtered(spark, sf):
    return M.latest_predictions(predictions(spark, sf), sentiment="negative", batch=7, limit=5,
                                keys_from=predictions(spark, sf, with_text=False)).select(
        "event_id", "processed_at", "score", "predicted_label", "batch_id")


@register("low_confidence", _sql(f"""
SELECT event_id, processed_at, score, predicted_label, round(confidence * 100.0, 2) AS confidence_pct,
       batch_id
FROM analytics WHERE confidence < {M.LOW_CONFIDENCE_THRESHOLD}
"""), ("predictions",))
def q_low_confidence(spark, sf):
    return M.low_confidence(_analytics(spark, sf)).select(
        "event_id", "processed_at", "score", "predicted_label",
        F.round(F.col("confidence") * 100.0, 2).alias("confidence_pct"), "batch_id")


SUSPICIOUS_WHERE = """((score = 5 AND predicted_label = 'negative') OR (score = 1 AND predicted_label = 'positive')
       OR (score IN (4, 5) AND predicted_label = 'neutral'))"""


@register("suspicious", _sql(f"""
SELECT event_id, score, predicted_label, batch_id FROM analytics WHERE {SUSPICIOUS_WHERE}
"""), ("predictions",))
def q_suspicious(spark, sf):
    return M.suspicious(_analytics(spark, sf)).select("event_id", "score", "predicted_label", "batch_id")


@register("kpis_empty", """
WITH analytics AS (SELECT * FROM predictions WHERE source = 'no_such_source'),
b AS (SELECT batch_id, count(*) AS records FROM analytics WHERE batch_id IS NOT NULL GROUP BY batch_id)
SELECT count(*) AS total_batches, CAST(COALESCE(sum(records), 0) AS BIGINT) AS total_records,
       CAST(COALESCE(avg(records), 0) AS DOUBLE) AS avg_records_per_batch,
       CAST(COALESCE(min(records), 0) AS BIGINT) AS min_records_per_batch,
       CAST(COALESCE(max(records), 0) AS BIGINT) AS max_records_per_batch,
       max(batch_id) AS latest_batch_id
FROM b
""", ("predictions",))
def q_kpis_empty(spark, sf):
    return M.batch_kpis(M.batch_summary(M.analytics_scan(predictions(spark, sf, with_text=False), "no_such_source")))


@register("score_distribution", _sql("""
SELECT score, count(*) AS count FROM analytics WHERE score IS NOT NULL GROUP BY score
"""), ("predictions",))
def q_score_distribution(spark, sf):
    return M.score_distribution(_analytics(spark, sf))


@register("confidence_by_sentiment", _sql("""
SELECT predicted_label, round(avg(confidence) * 100.0, 2) AS average_confidence
FROM analytics WHERE predicted_label IS NOT NULL GROUP BY predicted_label
"""), ("predictions",))
def q_confidence_by_sentiment(spark, sf):
    return M.confidence_by_sentiment(_analytics(spark, sf))


@register("batch_summary", _sql("""
SELECT batch_id, count(*) AS records FROM analytics WHERE batch_id IS NOT NULL GROUP BY batch_id
"""), ("predictions",))
def q_batch_summary(spark, sf):
    return M.batch_summary(_analytics(spark, sf))


@register("batch_kpis", _sql("""
, b AS (SELECT batch_id, count(*) AS records FROM analytics WHERE batch_id IS NOT NULL GROUP BY batch_id)
SELECT count(*) AS total_batches, CAST(COALESCE(sum(records), 0) AS BIGINT) AS total_records,
       CAST(COALESCE(avg(records), 0) AS DOUBLE) AS avg_records_per_batch,
       CAST(COALESCE(min(records), 0) AS BIGINT) AS min_records_per_batch,
       CAST(COALESCE(max(records), 0) AS BIGINT) AS max_records_per_batch,
       max(batch_id) AS latest_batch_id
FROM b
"""), ("predictions",))
def q_batch_kpis(spark, sf):
    return M.batch_kpis(M.batch_summary(_analytics(spark, sf)))


HIST_SQL = _sql(f"""
, binned AS (
  SELECT CASE WHEN confidence < 0 THEN NULL
              WHEN confidence <= 0.5 THEN 0 WHEN confidence <= 0.6 THEN 1
              WHEN confidence <= 0.7 THEN 2 WHEN confidence <= 0.8 THEN 3
              WHEN confidence <= 0.9 THEN 4 WHEN confidence <= 1.0 THEN 5 END AS bin
  FROM analytics),
bins(bin, confidence_range) AS (VALUES {", ".join(f"({i}, '{lbl}')" for i, lbl in enumerate(M.CONFIDENCE_LABELS))})
SELECT CAST(bins.bin AS INT) AS bin, bins.confidence_range, count(binned.bin) AS count
FROM bins LEFT JOIN binned ON binned.bin = bins.bin
GROUP BY bins.bin, bins.confidence_range
""")


@register("confidence_histogram", HIST_SQL, ("predictions",))
def q_confidence_histogram(spark, sf):
    return M.confidence_histogram(_analytics(spark, sf))


@register("score_by_sentiment", _sql("""
SELECT score, predicted_label, count(*) AS count FROM analytics
WHERE score IS NOT NULL AND predicted_label IS NOT NULL GROUP BY score, predicted_label
"""), ("predictions",))
def q_score_by_sentiment(spark, sf):
    return M.score_by_sentiment(_analytics(spark, sf))


@register("score_sentiment_crosstab", _sql("""
SELECT score, count(*) FILTER (WHERE predicted_label = 'negative') AS negative,
       count(*) FILTER (WHERE predicted_label = 'neutral') AS neutral,
       count(*) FILTER (WHERE predicted_label = 'positive') AS positive,
       count(*) FILTER (WHERE predicted_label = 'unknown') AS unknown,
       count(*) FILTER (WHERE predicted_label NOT IN ('negative', 'neutral', 'positive', 'unknown')) AS other
FROM analytics WHERE score IS NOT NULL AND predicted_label IS NOT NULL GROUP BY score
"""), ("predictions",))
def q_score_sentiment_crosstab(spark, sf):
    return M.score_sentiment_crosstab(_analytics(spark, sf))


@register("confidence_stats", _sql(f"""
SELECT round(avg(confidence) * 100.0, 2) AS average_confidence,
       round(median(confidence) * 100.0, 2) AS median_confidence,
       round(min(confidence) * 100.0, 2) AS min_confidence,
       round(max(confidence) * 100.0, 2) AS max_confidence,
       count(*) FILTER (WHERE confidence < {M.LOW_CONFIDENCE_THRESHOLD}) AS low_confidence_count
FROM analytics
"""), ("predictions",))
def q_confidence_stats(spark, sf):
    return M.confidence_stats(_analytics(spark, sf))


@register("available_batches", _sql("""
SELECT DISTINCT batch_id FROM analytics WHERE batch_id IS NOT NULL
"""), ("predictions",))
def q_available_batches(spark, sf):
    return M.available_batches(_analytics(spark, sf))


@register("count_by_source", """
SELECT source, count(*) AS count FROM predictions GROUP BY source
""", ("predictions",))
def q_count_by_source(spark, sf):
    return M.count_by_source(predictions(spark, sf, with_text=False))


@register("status_kpis", _sql(f"""
SELECT count(*) AS total_predictions, max(batch_id) AS latest_batch_id,
       round(avg(confidence) * 100.0, 2) AS average_confidence,
       count(*) FILTER (WHERE predicted_label = 'positive') AS positive_count,
       count(*) FILTER (WHERE predicted_label = 'negative') AS negative_count,
       count(*) FILTER (WHERE predicted_label = 'neutral') AS neutral_count,
       count(*) FILTER (WHERE confidence < {M.LOW_CONFIDENCE_THRESHOLD}) AS low_confidence_count
FROM analytics
"""), ("predictions",))
def q_status_kpis(spark, sf):
    return M.status_kpis(_analytics(spark, sf))


@register("sentiment_kpis", _sql("""
SELECT count(*) FILTER (WHERE predicted_label = 'positive') AS positive_count,
       count(*) FILTER (WHERE predicted_label = 'negative') AS negative_count,
       count(*) FILTER (WHERE predicted_label = 'neutral') AS neutral_count
FROM analytics
"""), ("predictions",))
def q_sentiment_kpis(spark, sf):
    return M.sentiment_kpis(_analytics(spark, sf))


@register("low_confidence_sample", _sql(f"""
SELECT event_id, processed_at, score, predicted_label, round(confidence * 100.0, 2) AS confidence_pct,
       batch_id
FROM analytics WHERE confidence < {M.LOW_CONFIDENCE_THRESHOLD}
ORDER BY processed_at DESC NULLS LAST, event_id DESC NULLS LAST LIMIT {M.SAMPLE_ROWS}
"""), ("predictions",))
def q_low_confidence_sample(spark, sf):
    return M.low_confidence_sample(_analytics(spark, sf))


@register("suspicious_sample", f"""
WITH latest AS (
  SELECT * FROM predictions WHERE source = '{STREAM_SOURCE}'
  ORDER BY processed_at DESC NULLS LAST, event_id DESC NULLS LAST LIMIT {M.DEFAULT_LIMIT})
SELECT event_id, processed_at, text_preview, score, predicted_label,
       round(list_max(probability) * 100.0, 2) AS confidence_pct, batch_id
FROM latest WHERE {SUSPICIOUS_WHERE}
ORDER BY processed_at DESC NULLS LAST, event_id DESC NULLS LAST LIMIT {M.SAMPLE_ROWS}
""", ("predictions",))
def q_suspicious_sample(spark, sf):
    return M.suspicious_sample(predictions(spark, sf), keys_from=predictions(spark, sf, with_text=False))


@register("latest_batches", _sql("""
SELECT batch_id, count(*) AS records FROM analytics WHERE batch_id IS NOT NULL
GROUP BY batch_id ORDER BY batch_id DESC LIMIT 10
"""), ("predictions",))
def q_latest_batches(spark, sf):
    return M.latest_batches(_analytics(spark, sf))


@register("batch_series", _sql("""
SELECT batch_id, count(*) AS records FROM analytics WHERE batch_id IS NOT NULL GROUP BY batch_id
"""), ("predictions",))
def q_batch_series(spark, sf):
    return M.batch_series(_analytics(spark, sf))


@register("purge_source", f"""
SELECT event_id, source FROM predictions WHERE source IS DISTINCT FROM '{TEST_SOURCE}'
""", ("predictions",))
def q_purge_source(spark, sf):
    return M.purge_source(predictions(spark, sf, with_text=False), TEST_SOURCE).select("event_id", "source")


@register("coerce_ts", """
SELECT event_id, raw, TRY_CAST(raw AS TIMESTAMP) AS parsed
FROM (SELECT event_id,
             CASE WHEN event_type = 'error' THEN props ELSE CAST(ts AS VARCHAR) END AS raw
      FROM events) e
""")
def q_coerce_ts(spark, sf):
    from sentiscope.sources.tables import table

    ev = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.col("props"))
         .otherwise(F.col("ts").cast("string")).alias("raw"))
    return ev.select("event_id", "raw", M.coerce_timestamp("raw").cast("timestamp_ntz").alias("parsed"))


REPORT_SQL = _sql(f"""
, s AS (
  SELECT count(*) AS n, avg(confidence) AS av, median(confidence) AS md, min(confidence) AS mn,
         max(confidence) AS mx, count(*) FILTER (WHERE confidence < {M.LOW_CONFIDENCE_THRESHOLD}) AS low
  FROM analytics),
b AS (SELECT batch_id, count(*) AS records FROM analytics WHERE batch_id IS NOT NULL GROUP BY batch_id),
k AS (SELECT count(*) AS nb, COALESCE(sum(records), 0) AS nr, COALESCE(avg(records), 0) AS ar,
             COALESCE(min(records), 0) AS mnr, COALESCE(max(records), 0) AS mxr, max(batch_id) AS lb FROM b)
SELECT 'executive_summary' AS section, 1 AS position, 'Total predictions' AS metric, format('{{:,}}', n) AS value FROM s
UNION ALL SELECT 'executive_summary', 2, 'Average confidence', COALESCE(printf('%.2f%%', av * 100.0), 'N/A') FROM s
UNION ALL SELECT 'executive_summary', 3, 'Median confidence', COALESCE(printf('%.2f%%', md * 100.0), 'N/A') FROM s
UNION ALL SELECT 'executive_summary', 4, 'Minimum confidence', COALESCE(printf('%.2f%%', mn * 100.0), 'N/A') FROM s
UNION ALL SELECT 'executive_summary', 5, 'Maximum confidence', COALESCE(printf('%.2f%%', mx * 100.0), 'N/A') FROM s
UNION ALL SELECT 'executive_summary', 6, 'Low-confidence predictions below 60%', format('{{:,}}', low) FROM s
UNION ALL SELECT 'streaming_batch_summary', 1, 'Total micro-batches', format('{{:,}}', nb) FROM k
UNION ALL SELECT 'streaming_batch_summary', 2, 'Total records', format('{{:,}}', nr) FROM k
UNION ALL SELECT 'streaming_batch_summary', 3, 'Average records per micro-batch', printf('%.2f', ar) FROM k
UNION ALL SELECT 'streaming_batch_summary', 4, 'Minimum records in one micro-batch', format('{{:,}}', mnr) FROM k
UNION ALL SELECT 'streaming_batch_summary', 5, 'Maximum records in one micro-batch', format('{{:,}}', mxr) FROM k
UNION ALL SELECT 'streaming_batch_summary', 6, 'Latest batch ID', COALESCE(CAST(lb AS VARCHAR), 'N/A') FROM k
""")


@register("report_summary", REPORT_SQL, ("predictions",))
def q_report_summary(spark, sf):
    return report_summary(_analytics(spark, sf))


@register("dashboard_counts", _sql("""
SELECT CASE GROUPING_ID(predicted_label, score, batch_id) WHEN 3 THEN 'sentiment' WHEN 5 THEN 'score'
            WHEN 6 THEN 'batch' WHEN 1 THEN 'score_sentiment' END AS grouping,
       predicted_label, score, batch_id, count(*) AS count
FROM analytics
GROUP BY GROUPING SETS ((predicted_label), (score), (batch_id), (score, predicted_label))
HAVING (GROUPING_ID(predicted_label, score, batch_id) = 3 AND predicted_label IS NOT NULL)
    OR (GROUPING_ID(predicted_label, score, batch_id) = 5 AND score IS NOT NULL)
    OR (GROUPING_ID(predicted_label, score, batch_id) = 6 AND batch_id IS NOT NULL)
    OR (GROUPING_ID(predicted_label, score, batch_id) = 1 AND score IS NOT NULL AND predicted_label IS NOT NULL)
"""), ("predictions",))
def q_dashboard_counts(spark, sf):
    return M.dashboard_counts(_analytics(spark, sf))


@register("store_roundtrip", f"""
SELECT event_id, source, batch_id, CAST(NULL AS VARCHAR) AS text, score, predicted_label
FROM predictions WHERE source = '{TEST_SOURCE}'
""", ("predictions",))
def q_store_roundtrip(spark, sf):
    """Connection-test documents appended to a scratch store, then fetched back by id."""
    import uuid

    from sentiscope.session import scratch_path
    from sentiscope.sources import store as ST

    path = scratch_path(spark, f"store-{uuid.uuid4().hex[:12]}")
    docs = predictions(spark, sf).where(F.col("source") == F.lit(TEST_SOURCE)).drop("text")
    ST.insert_documents(docs, path)
    back = ST.read_store(spark, path)
    ids = docs.select(F.col("event_id").alias("_id"))
    return back.join(ids, back.event_id == ids._id, "left_semi").select(
        "event_id", "source", "batch_id", "text", "score", "predicted_label")


ROLLUP_SQL = _sql(f"""
, c AS (SELECT *, CASE WHEN confidence <= 0.5 THEN 0 WHEN confidence <= 0.6 THEN 1 WHEN confidence <= 0.7 THEN 2
                  WHEN confidence <= 0.8 THEN 3 WHEN confidence <= 0.9 THEN 4 WHEN confidence <= 1 THEN 5 END AS bin FROM analytics)
SELECT 'sentiment' AS kpi, predicted_label AS key, CAST(count(*) AS DOUBLE) AS value FROM c WHERE predicted_label IS NOT NULL GROUP BY 2
UNION ALL SELECT 'score', CAST(score AS VARCHAR), count(*) FROM c WHERE score IS NOT NULL GROUP BY 2
UNION ALL SELECT 'batch', CAST(batch_id AS VARCHAR), count(*) FROM c WHERE batch_id IS NOT NULL GROUP BY 2
UNION ALL SELECT 'score_sentiment', CAST(score AS VARCHAR) || ' ' || predicted_label, count(*) FROM c WHERE score IS NOT NULL AND predicted_label IS NOT NULL GROUP BY 2
UNION ALL SELECT 'average_confidence', predicted_label, round(avg(confidence) * 100.0, 2) FROM c WHERE predicted_label IS NOT NULL GROUP BY 2
UNION ALL SELECT 'histogram', CAST(g.bin AS VARCHAR), count(c.bin) FROM (SELECT unnest(range(6)) AS bin) g LEFT JOIN c ON c.bin = g.bin GROUP BY 2
UNION ALL SELECT 'status', 'total', count(*) FROM c
UNION ALL SELECT 'status', 'latest_batch', max(batch_id) FROM c
UNION ALL SELECT 'status', 'low_confidence', count(*) FILTER (WHERE confidence < {M.LOW_CONFIDENCE_THRESHOLD}) FROM c
UNION ALL SELECT 'status', 'average_confidence', round(avg(confidence) * 100.0, 2) FROM c
UNION ALL SELECT 'confidence', 'median', round(median(confidence) * 100.0, 2) FROM c
UNION ALL SELECT 'confidence', 'min', round(min(confidence) * 100.0, 2) FROM c
UNION ALL SELECT 'confidence', 'max', round(max(confidence) * 100.0, 2) FROM c
""")
ROLLUP_BATCHES = 8


@register("rollup_dashboard", ROLLUP_SQL, ("predictions",))
def q_rollup_dashboard(spark, sf):
    """The dashboard's numbers from rollups only: a store is written batch range by batch range, one range is
    replayed, the older half is compacted, and the merged rollups answer."""
    import uuid

    from sentiscope.operators import rollups as RU
    from sentiscope.session import scratch_path
    from sentiscope.sources import rollups as RS
    from sentiscope.sources import store as ST

    path = scratch_path(spark, f"rolled-{uuid.uuid4().hex[:12]}")
    rows = predictions(spark, sf, with_text=False).withColumn("run_id", F.lit("replay"))
    ST.write_partitions(rows.repartition(max(ROLLUP_BATCHES, 2 * spark.sparkContext.defaultParallelism), "batch_id"), path)
    RS.refresh_rollups(spark, path, F.lit(True))
    half = rows.agg(F.floor(F.max("batch_id") / 2)).first()[0]
    again = F.col("batch_id") == F.lit(half)
    ST.write_partitions(rows.where(again), path)
    RS.refresh_rollups(spark, path, again)
    ST.compact_batches(spark, path, STREAM_SOURCE, half)
    cells, values = RS.read_rollups(spark, path, STREAM_SOURCE)

    def part(name, frame, key, value):
        return frame.select(F.lit(name).alias("kpi"), key.cast("string").alias("key"), F.col(value).cast("double").alias("value"))

    def wide(name, frame, **columns):
        return frame.select(F.lit(name).alias("kpi"), F.inline(F.array(*[
            F.struct(F.lit(k).alias("key"), F.col(c).cast("double").alias("value")) for k, c in columns.items()])))

    parts = [part("sentiment", RU.sentiment_summary(cells), F.col("sentiment"), "count"),
             part("score", RU.score_distribution(cells), F.col("score"), "count"),
             part("batch", RU.batch_summary(cells), F.col("batch_id"), "records"),
             part("score_sentiment", RU.score_by_sentiment(cells), F.concat_ws(" ", F.col("score").cast("string"), "predicted_label"), "count"),
             part("average_confidence", RU.confidence_by_sentiment(cells), F.col("predicted_label"), "average_confidence"),
             part("histogram", RU.confidence_histogram(cells), F.col("bin"), "count"),
             wide("status", RU.status_kpis(cells), total="total_predictions", latest_batch="latest_batch_id",
                  low_confidence="low_confidence_count", average_confidence="average_confidence"),
             wide("confidence", RU.confidence_stats(values), median="median_confidence", min="min_confidence", max="max_confidence")]
    return reduce(DataFrame.unionByName, parts)


@register("confidence_stats_approx")
def q_confidence_stats_approx(spark, sf):
    """A19 in one pass with a sketch median (no exact oracle: the sketches differ)."""
    return M.confidence_stats_approx(_analytics(spark, sf))
