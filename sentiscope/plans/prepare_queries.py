"""Registered preparation queries: scan, validate, quarantine, label, split, weight."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentiscope.catalog import register
from sentiscope.functions.hashing import hash_fraction_sql
from sentiscope.operators import prepare as P
from sentiscope.sources.fixtures import labelled, message_payload, reviews

U_SQL = hash_fraction_sql("doc_id", P.RANDOM_SEED)
SPLIT_SQL = f"CASE WHEN {U_SQL} < 0.8 THEN 'train' WHEN {U_SQL} < 0.8 + 0.1 THEN 'val' ELSE 'test' END"
RESUME_AT = 20
# the publishable rows of the exported test split, with their positions
POSITIONS_SQL = f"""
pos AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, text, score, label FROM labelled
        WHERE {SPLIT_SQL} = 'test' AND text IS NOT NULL)
"""


def exported_test_split(spark, sf) -> str:
    """The test split, written as JSON lines in document order to the scratch folder."""
    import uuid

    from sentiscope.session import scratch_path
    from sentiscope.sources import files

    path = scratch_path(spark, f"export-{uuid.uuid4().hex[:12]}")
    _, _, test = P.split_frames(labelled(spark, sf))
    files.export_jsonl(test, path, order="doc_id")
    return path


@register("scan_reviews", """
SELECT translate(Text, chr(10) || chr(13), '  ') AS Text, Score FROM reviews WHERE Text IS NOT NULL AND Score IS NOT NULL
""", ("reviews",))
def q_scan_reviews(spark, sf):
    """Reviews on one line each, written as CSV to the scratch folder and read by the single-line scan (by header names)."""
    import uuid

    from sentiscope.session import scratch_path
    from sentiscope.sources import files

    path = scratch_path(spark, f"csv-{uuid.uuid4().hex[:12]}")
    lines = reviews(spark, sf).withColumn("Text", F.translate("Text", "\n\r", "  "))
    (lines.write.option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return files.scan_reviews(spark, path)


@register("clean_reviews", """
SELECT doc_id, Text AS text, CAST(TRIM(Score) AS INT) AS score FROM reviews
WHERE Text IS NOT NULL AND TRIM(Score) IS NOT NULL AND regexp_matches(TRIM(Score), '^[1-5]$')
""", ("reviews",))
def q_clean_reviews(spark, sf):
    return P.clean_reviews(reviews(spark, sf))


@register("label_reviews", """
SELECT doc_id, text, score, label FROM labelled
""", ("labelled",))
def q_label_reviews(spark, sf):
    return P.label_reviews(P.clean_reviews(reviews(spark, sf)))


@register("label_with_unknown", """
SELECT doc_id, sc AS score,
       CASE WHEN sc IS NULL THEN 'unknown' WHEN sc < 3 THEN 'negative' WHEN sc = 3 THEN 'neutral'
            ELSE 'positive' END AS label
FROM (SELECT doc_id, TRY_CAST(TRIM(Score) AS INT) AS sc FROM reviews) r
""", ("reviews",))
def q_label_with_unknown(spark, sf):
    frame = reviews(spark, sf).select("doc_id", F.expr("try_cast(trim(Score) AS INT)").alias("score"))
    return P.label_with_unknown(frame)


@register("coerce_score", """
SELECT doc_id, Score, TRY_CAST(TRIM(Score) AS DOUBLE) AS score_num FROM reviews
""", ("reviews",))
def q_coerce_score(spark, sf):
    return reviews(spark, sf).select("doc_id", "Score", P.coerce_score(F.trim("Score")).alias("score_num"))


@register("valid_range", """
SELECT doc_id, s AS score FROM
  (SELECT doc_id, CAST(trunc(TRY_CAST(TRIM(Score) AS DOUBLE)) AS INT) AS s FROM reviews WHERE Text IS NOT NULL) r
WHERE s BETWEEN 1 AND 5
""", ("reviews",))
def q_valid_range(spark, sf):
    frame = reviews(spark, sf).where(F.col("Text").isNotNull()).select("doc_id", P.truncated_score("Score").alias("score"))
    return P.valid_range(frame)


@register("bad_rows", """
SELECT doc_id, Score, CASE WHEN Score IS NULL THEN 'missing_score' ELSE 'non_numeric_score' END AS reason
FROM reviews WHERE Text IS NOT NULL AND TRY_CAST(TRIM(Score) AS DOUBLE) IS NULL
""", ("reviews",))
def q_bad_rows(spark, sf):
    return P.quarantine(reviews(spark, sf))


@register("sample_head", f"""
SELECT doc_id, text, score, label FROM labelled ORDER BY doc_id LIMIT {P.SAMPLE_ROWS}
""", ("labelled",))
def q_sample_head(spark, sf):
    return P.sample_head(labelled(spark, sf))


@register("class_distribution", """
SELECT label, count(*) AS count FROM labelled GROUP BY label
""", ("labelled",))
def q_class_distribution(spark, sf):
    return labelled(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("count"))


@register("raw_score_distribution", """
SELECT score, count(*) AS count FROM labelled GROUP BY score
""", ("labelled",))
def q_raw_score_distribution(spark, sf):
    return (labelled(spark, sf).groupBy("score").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("score"))


@register("split_random", f"""
SELECT doc_id, label, {SPLIT_SQL} AS split FROM labelled
""", ("labelled",))
def q_split_random(spark, sf):
    return P.split_random(labelled(spark, sf)).select("doc_id", "label", "split")


@register("split_sizes", f"""
SELECT {SPLIT_SQL} AS split, count(*) AS count FROM labelled GROUP BY 1
""", ("labelled",))
def q_split_sizes(spark, sf):
    return P.split_random(labelled(spark, sf)).groupBy("split").agg(F.count(F.lit(1)).alias("count"))


@register("split_class_distribution", f"""
SELECT {SPLIT_SQL} AS split, label, count(*) AS count FROM labelled GROUP BY 1, 2
""", ("labelled",))
def q_split_class_distribution(spark, sf):
    return (P.split_random(labelled(spark, sf)).groupBy("split", "label")
            .agg(F.count(F.lit(1)).alias("count")))


@register("class_weights", f"""
WITH c AS (SELECT label, count(*) AS count FROM labelled WHERE {SPLIT_SQL} = 'train' GROUP BY label)
SELECT label, count, CAST(sum(count) OVER () AS DOUBLE) / (count(*) OVER () * count) AS class_weight FROM c
""", ("labelled",))
def q_class_weights(spark, sf):
    train, _, _ = P.split_frames(labelled(spark, sf))
    return P.class_weight_table(train)


@register("weighted_train", f"""
WITH t AS (SELECT * FROM labelled WHERE {SPLIT_SQL} = 'train'),
c AS (SELECT label, count(*) AS count FROM t GROUP BY label),
w AS (SELECT label, CAST(sum(count) OVER () AS DOUBLE) / (count(*) OVER () * count) AS class_weight FROM c)
SELECT t.doc_id, t.label, w.class_weight FROM t JOIN w ON t.label = w.label
""", ("labelled",))
def q_weighted_train(spark, sf):
    train, _, _ = P.split_frames(labelled(spark, sf))
    return P.add_class_weights(train).select("doc_id", "label", "class_weight")


@register("split_stratified", f"""
WITH r AS (
  SELECT doc_id, label,
         row_number() OVER (PARTITION BY label ORDER BY {U_SQL}, doc_id) - 1 AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM labelled),
q AS (SELECT *, floor((n * 80 + 50) / 100) AS n_train FROM r)
SELECT doc_id, label,
       CASE WHEN rk < n_train THEN 'train'
            WHEN rk < n_train + floor(((n - n_train) * 50 + 50) / 100) THEN 'val'
            ELSE 'test' END AS split
FROM q
""", ("labelled",))
def q_split_stratified(spark, sf):
    return P.split_stratified(labelled(spark, sf)).select("doc_id", "label", "split")


@register("resume_offset", f"""
WITH {POSITIONS_SQL.strip()}
SELECT row_index, score FROM pos WHERE row_index >= {RESUME_AT}
""", ("labelled",))
def q_resume_offset(spark, sf):
    from sentiscope.streaming.publish import exported_rows

    return P.resume_from(exported_rows(spark, exported_test_split(spark, sf)), RESUME_AT).select("row_index", "score")


@register("publish_events", f"""
WITH {POSITIONS_SQL.strip()}
SELECT row_index, CAST(to_json({{'text': text, 'score': score, 'source_split': 'test', 'source_row_index': row_index}}) AS VARCHAR) AS value
FROM pos
""", ("labelled",))
def q_publish_events(spark, sf):
    """Test split exported, read back, positions given, messages encoded."""
    from sentiscope.streaming.publish import messages_from_export

    return messages_from_export(spark, exported_test_split(spark, sf))


@register("export_test_split", f"""
SELECT text, CAST(score AS VARCHAR) AS score, label FROM labelled WHERE {SPLIT_SQL} = 'test'
""", ("labelled",))
def q_export_test_split(spark, sf):
    """The lines that the export wrote, values as written."""
    from sentiscope.sources import files

    return files.scan_jsonl(spark, exported_test_split(spark, sf), files.RAW_JSONL_SCHEMA)


@register("parse_events", """
SELECT doc_id, CAST(json_extract_string(value, '$.text') AS VARCHAR) AS text,
       TRY_CAST(json_extract(value, '$.score') AS INT) AS score
FROM messages WHERE json_extract_string(value, '$.text') IS NOT NULL
""", ("messages",))
def q_parse_events(spark, sf):
    from sentiscope.streaming.parse import parse_messages

    msgs = labelled(spark, sf).select("doc_id", message_payload().alias("value"))
    return parse_messages(msgs, keep=("doc_id",))


@register("scan_reviews_strict", """
SELECT doc_id, Text AS text, CAST(TRIM(Score) AS INT) AS score FROM reviews
WHERE Text IS NOT NULL AND TRIM(Score) IS NOT NULL AND regexp_matches(TRIM(Score), '^[1-5]$')
""", ("reviews",))
def q_scan_reviews_strict(spark, sf):
    """Reviews written as multi-line CSV to the scratch folder, ingested by the strict scan."""
    import uuid

    from sentiscope.session import scratch_path
    from sentiscope.sources import files

    base = scratch_path(spark, f"csv-{uuid.uuid4().hex[:12]}")
    (reviews(spark, sf).write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{base}/csv"))
    strict = files.ingest_strict(spark, f"{base}/csv", f"{base}/parquet")
    return P.clean_reviews(strict).select("doc_id", "text", "score")


@register("scan_jsonl", f"""
SELECT text, score, label FROM labelled WHERE {SPLIT_SQL} = 'test'
""", ("labelled",))
def q_scan_jsonl(spark, sf):
    """The exported test split read back through the JSON-lines scan."""
    import uuid

    from sentiscope.session import scratch_path
    from sentiscope.sources import files

    path = scratch_path(spark, f"jsonl-{uuid.uuid4().hex[:12]}")
    _, _, test = P.split_frames(labelled(spark, sf))
    files.export_jsonl(test, path)
    return files.scan_jsonl(spark, path)
