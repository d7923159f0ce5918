"""Review-domain relations derived from the driver tables.

The reference reads a review CSV and a document store that are not shipped, so
these relations are derived from ``documents``, ``labels`` and ``events`` (see
FIXTURES.md).  Each relation has a Spark builder and the equivalent DuckDB SQL
(``*_SQL``), kept side by side so the oracle always inlines the same definition.

* ``reviews``     – dirty raw input: ``doc_id, Text, Score`` (Score is a string
  that may be null, padded or non-numeric)
* ``labelled``    – validated ``doc_id, text, score, label``
* ``predictions`` – the scored prediction store
* ``scored``      – ``event_id, label_index, prediction`` evaluation input
* ``messages``    – JSON stream payloads built from ``labelled``

Every relation grows with its source tables: ``predictions`` maps each event to
a document by ``event_id mod (number of documents)``, so all documents are used
(a left join: a store row exists with or without its text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiscope.functions.labels import score_to_label
from sentiscope.session import spread
from sentiscope.sources.tables import table

# Fixed values of the store.
STREAM_SOURCE = "spark_structured_streaming"
TEST_SOURCE = "python_test"


# ---------------------------------------------------------------- reviews
def reviews(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", how).select(
        "doc_id", F.col("text").alias("Text"), _raw_score().alias("Score"))


def _raw_score() -> Column:
    """The dirty score of a ``labels`` row."""
    return (
        F.when(F.col("quality").isNull(), F.lit(None).cast("string"))
        .when(F.col("doc_id") % 17 == 0, F.lit("bad"))
        .when((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit(" 1 "))
        .when(F.col("quality") == 0, F.lit("2"))
        .when(F.col("toxic") == 1, F.lit("3"))
        .when(F.col("doc_id") % 2 == 0, F.lit("4"))
        .otherwise(F.lit("5"))
    )


REVIEWS_SQL = """
SELECT d.doc_id, d.text AS Text,
       CASE WHEN l.quality IS NULL THEN NULL
            WHEN d.doc_id % 17 = 0 THEN 'bad'
            WHEN l.quality = 0 AND l.toxic = 1 THEN ' 1 '
            WHEN l.quality = 0 THEN '2'
            WHEN l.toxic = 1 THEN '3'
            WHEN d.doc_id % 2 = 0 THEN '4'
            ELSE '5' END AS Score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


# --------------------------------------------------------------- labelled
def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated reviews.  Scores are validated on the label side, so only texts with a
    usable score pass the (inner) join; text work downstream is CPU-heavy, so a small
    text scan is spread first (see ``session.spread``)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    scores = (table(spark, sf_dir, "labels")
              .select("doc_id", F.trim(_raw_score()).try_cast("int").alias("score"))
              .where(F.col("score").between(1, 5))
              .withColumn("label", score_to_label("score")))
    return docs.join(scores, "doc_id")


LABELLED_SQL = """
SELECT doc_id, Text AS text, sc AS score,
       CASE WHEN sc < 3 THEN 'negative' WHEN sc = 3 THEN 'neutral' ELSE 'positive' END AS label
FROM (SELECT doc_id, Text, TRY_CAST(TRIM(Score) AS INT) AS sc FROM reviews) r
WHERE sc BETWEEN 1 AND 5
"""


# ------------------------------------------------------------ predictions
def _prediction_index(event_type: Column) -> Column:
    return (F.when(event_type.isin("purchase", "click", "signup"), F.lit(0))
            .when(event_type == "error", F.lit(1)).otherwise(F.lit(2))).cast("double")


def _probability(conf: Column, pred: Column) -> Column:
    rest = (F.lit(1.0) - conf) / F.lit(2.0)
    return (F.when(conf.isNull(), F.array().cast("array<double>"))
            .when(pred == 0, F.array(conf, rest, rest))
            .when(pred == 1, F.array(rest, conf, rest))
            .otherwise(F.array(rest, rest, conf)))


def predictions(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """The prediction store: one row per scored event.

    Columns: ``event_id, text_preview, text, score, prediction, predicted_label,
    probability array<double>, batch_id, processed_at, source``.  One row in 50
    imitates the connection-test document (other source, null batch, empty
    probability).

    A store row exists whether or not its document text does: the texts come
    from ``events LEFT JOIN documents`` on the document key (``doc_id`` is unique).
    With ``with_text=False`` the two text columns are left out and so is the
    join - the same rows by that definition - so queries that never show text
    scan only ``events`` (no documents scan, no document-count subquery).
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    is_test = F.col("event_id") % 50 == 0
    conf = F.when(is_test, F.lit(None).cast("double")).otherwise(
        (F.lit(34) + (F.col("user_id") * 7 + F.col("event_id")) % 66).cast("double") / F.lit(100))
    cols = ["event_id", "ts", "event_type", conf.alias("_conf"),
            _prediction_index(F.col("event_type")).alias("prediction")]
    if with_text:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
        ev = events.select(*cols, F.pmod(F.col("event_id"), n_docs).alias("doc_key"))
        base = ev.join(docs, ev.doc_key == docs.doc_id, "left")
        text_cols = [F.substring("text", 1, 120).alias("text_preview"), "text"]
    else:
        base = events.select(*cols)
        text_cols = []
    return base.select(
        "event_id",
        *text_cols,
        (F.lit(1) + F.col("event_id") % 5).cast("int").alias("score"),
        "prediction",
        (F.when(F.col("prediction") == 0, F.lit("positive"))
         .when(F.col("prediction") == 1, F.lit("negative"))
         .otherwise(F.lit("neutral"))).alias("predicted_label"),
        _probability(F.col("_conf"), F.col("prediction")).alias("probability"),
        F.when(is_test, F.lit(None).cast("bigint"))
         .otherwise(F.floor(F.col("event_id") / 100).cast("bigint")).alias("batch_id"),
        F.col("ts").alias("processed_at"),
        F.when(is_test, F.lit(TEST_SOURCE)).otherwise(F.lit(STREAM_SOURCE)).alias("source"),
    )


PREDICTIONS_SQL = """
SELECT e.event_id, SUBSTRING(d.text, 1, 120) AS text_preview, d.text AS text,
       CAST(1 + e.event_id % 5 AS INT) AS score,
       e.prediction,
       CASE WHEN e.prediction = 0 THEN 'positive' WHEN e.prediction = 1 THEN 'negative'
            ELSE 'neutral' END AS predicted_label,
       CASE WHEN e.conf IS NULL THEN CAST([] AS DOUBLE[])
            WHEN e.prediction = 0 THEN [e.conf, (1 - e.conf) / 2, (1 - e.conf) / 2]
            WHEN e.prediction = 1 THEN [(1 - e.conf) / 2, e.conf, (1 - e.conf) / 2]
            ELSE [(1 - e.conf) / 2, (1 - e.conf) / 2, e.conf] END AS probability,
       CASE WHEN e.event_id % 50 = 0 THEN NULL
            ELSE CAST(FLOOR(e.event_id / 100) AS BIGINT) END AS batch_id,
       e.ts AS processed_at,
       CASE WHEN e.event_id % 50 = 0 THEN 'python_test' ELSE 'spark_structured_streaming' END AS source
FROM (SELECT event_id, ts, user_id,
             event_id % (SELECT count(*) FROM documents) AS doc_key,
             CASE WHEN event_id % 50 = 0 THEN NULL
                  ELSE CAST(34 + (user_id * 7 + event_id) % 66 AS DOUBLE) / 100 END AS conf,
             CAST(CASE WHEN event_type IN ('purchase','click','signup') THEN 0
                       WHEN event_type = 'error' THEN 1 ELSE 2 END AS DOUBLE) AS prediction
      FROM events) e
LEFT JOIN documents d ON d.doc_id = e.doc_key
"""


# ----------------------------------------------------------------- scored
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    return ev.select(
        "event_id",
        (F.col("event_id") % 3).cast("double").alias("label_index"),
        F.when(F.col("user_id") % 4 == 0, (F.col("event_id") + 1) % 3)
         .otherwise(F.col("event_id") % 3).cast("double").alias("prediction"),
    )


SCORED_SQL = """
SELECT event_id,
       CAST(event_id % 3 AS DOUBLE) AS label_index,
       CAST(CASE WHEN user_id % 4 = 0 THEN (event_id + 1) % 3 ELSE event_id % 3 END AS DOUBLE) AS prediction
FROM events
"""


# --------------------------------------------------------------- messages
def message_payload(text="text", score="score", row_index="doc_id", split: str = "test") -> Column:
    """JSON payload of one stream message (text, score, split name, row index)."""
    return F.to_json(F.struct(
        F.col(text).alias("text"), F.col(score).alias("score"),
        F.lit(split).alias("source_split"), F.col(row_index).alias("source_row_index")))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select(
        "doc_id", message_payload().alias("value"))


MESSAGES_SQL = """
SELECT doc_id,
       CAST(to_json({'text': text, 'score': score, 'source_split': 'test',
                     'source_row_index': doc_id}) AS VARCHAR) AS value
FROM labelled
"""


# ---------------------------------------------------------------- trials
def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial log, one row per nation: its customers give scores, its number the step."""
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    per_nation = customers.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c_custkey") % 7).alias("s"), F.sum(F.col("c_custkey") % 3).alias("a"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    step = F.col("n_nationkey")
    return nations.join(per_nation, nations.n_nationkey == per_nation.c_nationkey).select(
        step.cast("int").alias("step"), ((step == 0) | (F.col("n_regionkey") % 2 == 1)).alias("accepted"),
        (F.lit(0.5) / (step + 1)).alias("temperature"),
        F.round(F.col("s") / F.col("n") / 6, 2).alias("macro_f1"), F.round(F.col("a") / F.col("n") / 2, 2).alias("accuracy"))


TRIALS_SQL = """
SELECT CAST(n_nationkey AS INT) AS step, n_nationkey = 0 OR n_regionkey % 2 = 1 AS accepted, 0.5::DOUBLE / (n_nationkey + 1) AS temperature,
       round(s / n / 6, 2) AS macro_f1, round(a / n / 2, 2) AS accuracy
FROM nation JOIN (SELECT c_nationkey, count(*) AS n, CAST(sum(c_custkey % 7) AS DOUBLE) AS s, CAST(sum(c_custkey % 3) AS DOUBLE) AS a
                  FROM customer GROUP BY c_nationkey) c ON n_nationkey = c_nationkey
"""


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the fixtures it uses (dependencies first)."""
    order = ["reviews", "labelled", "predictions", "scored", "messages", "trials"]
    deps = {"labelled": ["reviews"], "messages": ["reviews", "labelled"]}
    need: list[str] = []
    for n in names:
        for d in deps.get(n, []) + [n]:
            if d not in need:
                need.append(d)
    bodies = {"reviews": REVIEWS_SQL, "labelled": LABELLED_SQL, "predictions": PREDICTIONS_SQL,
              "scored": SCORED_SQL, "messages": MESSAGES_SQL,
              "trials": TRIALS_SQL}
    ctes = [f"{n} AS ({bodies[n].strip()})" for n in order if n in need]
    body = sql.strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        # the query has CTEs of its own: append them after the fixtures
        own = body[4:].lstrip()
        recursive = own[:9].upper() == "RECURSIVE"
        head = "WITH RECURSIVE " if recursive else "WITH "
        return head + ",\n".join(ctes) + ",\n" + (own[9:].lstrip() if recursive else own)
    return "WITH " + ",\n".join(ctes) + "\n" + body
