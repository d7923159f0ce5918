"""Operator 1: mixing sources to target weights.

Weighted sampling without replacement by Efraimidis and Spirakis: a document with
quality weight ``w`` and a hashed uniform ``u`` gets the exponential key
``-ln(u) / w``; within a source, documents are taken in ascending key order until
the source's word budget is full.  A budget above the source's size first takes
whole epochs of every document and only then the fractional part by key order.

Budgets: the sources, in code-point order (null last), weigh ``weights`` repeated;
they share ``share`` times all words, but none takes more than ``max_epochs`` times
its own.  What is above that is reshared by weight (water filling), solved in
closed form over the small table of sources.

The prefix sum has no one-task-per-source window: the keys map monotonically to
``buckets`` ranges, bucket sums are cumulated per source, and only the one bucket
that holds a source's budget limit is ordered row by row.

Defined results: a null text has size 0 and takes 0; a null source is a source of
its own; a null id hashes like the word ``null``; ties of the key go by id, then by
size, and repeated rows are separate documents.  The document on the limit takes
the words that still fit, so each budget is met to within one word.  An empty table
gives no rows.  Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentiscope.llm.common import (SYMBOLS, materialise, symbol_count, text_or_empty, unit_hash, unit_hash_sql,
                                   word_count)

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
BUCKETS = 4096
MIN_QUALITY = 0.1


def quality_weight(text: Column) -> Column:
    """Share of characters that are not symbols, at least ``MIN_QUALITY``; 1 for an empty text."""
    n = F.length(text)
    clean = F.when(n > 0, F.lit(1.0) - symbol_count(text) / n).otherwise(F.lit(1.0))
    return F.greatest(clean, F.lit(MIN_QUALITY))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` -> plus ``target``: weighted shares, capped and reshared.

    A source is full if its cap is at most its share of what the sources with a
    smaller cap per weight have left; the others share the rest by weight.  One row
    per source goes through the windows.
    """
    table = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("weight", F.get(table, rank % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    everything = Window.partitionBy()
    upward = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = upward.rowsBetween(Window.unboundedPreceding, -1)
    onward = upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    words = F.sum("source_size").over(everything) * F.lit(float(share))
    left = words - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    level = left / F.sum("weight").over(onward)
    full = F.col("level") >= F.col("cap") / F.col("weight")
    levels = ranked.withColumn("level", level).withColumn("full", full).withColumn("place", F.row_number().over(upward))
    first_open = F.min(F.when(~F.col("full"), F.struct("place", "level"))).over(everything)["level"]
    return levels.withColumn("open_level", first_open).select(
        "source", "source_size",
        F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("open_level")).alias("target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        buckets: int = BUCKETS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, epochs, taken``.

    ``epochs`` counts the whole copies, ``taken`` the words with repeats.
    """
    text = text_or_empty(text_col)
    keyed = materialise(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
                    (-F.log(unit_hash(F.col(id_col), seed)) / quality_weight(text)).alias("key"))
        .withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * buckets), F.lit(buckets - 1)).cast("int")))
    per_bucket = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(per_bucket.groupBy("source").agg(F.sum("words").alias("source_size")),
                             weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budgets = (targets.withColumn("epochs", whole.cast("long"))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))

    # the bucket in which each source's fractional budget ends, and the words before it
    in_order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = per_bucket.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0)))
    limits = (sums.withColumnRenamed("source", "s").join(budgets, F.col("s").eqNullSafe(F.col("source")))
              .groupBy("source", "source_size", "target", "epochs", "rest")
              .agg(F.min(F.when(F.col("before") + F.col("words") > F.col("rest"), F.struct("bucket", "before"))).alias("cut")))
    limits = limits.select(F.col("source").alias("s"), "source_size", "target", "epochs", "rest",
                           F.coalesce("cut.bucket", F.lit(buckets)).alias("cut_bucket"),
                           F.coalesce("cut.before", F.lit(0)).alias("cut_before"))

    rows = keyed.join(limits, F.col("source").eqNullSafe(F.col("s")))
    at_limit = F.col("bucket") == F.col("cut_bucket")
    by_key = (Window.partitionBy("source").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    room = F.floor(F.col("rest") - F.col("cut_before") - F.coalesce(F.sum("size").over(by_key), F.lit(0)))
    cut = rows.where(at_limit).withColumn("part", F.greatest(F.least(room, F.col("size")), F.lit(0)))
    sure = rows.where(~at_limit).withColumn(
        "part", F.when(F.col("bucket") < F.col("cut_bucket"), F.col("size")).otherwise(F.lit(0)))
    return sure.unionByName(cut).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         -ln({unit_hash_sql('doc_id', SEED)}) / greatest({MIN_QUALITY}, CASE WHEN length(COALESCE(text, '')) > 0
           THEN 1.0 - CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS DOUBLE) / length(text)
           ELSE 1.0 END) AS key
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         CAST([{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]
              AS DOUBLE) AS weight
  FROM d GROUP BY source),
c AS (SELECT *, source_size * {float(MAX_EPOCHS)} AS cap FROM s),
l AS (
  SELECT *, row_number() OVER up AS place,
         ((SELECT sum(source_size) FROM s) * {SHARE} - (sum(cap) OVER up - cap))
           / (sum(weight) OVER () - (sum(weight) OVER up - weight)) AS level
  FROM c WINDOW up AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT source, source_size,
         CASE WHEN level >= cap / weight THEN cap
              ELSE weight * (SELECT level FROM l WHERE level < cap / weight ORDER BY place LIMIT 1) END AS target
  FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(epochs * size + greatest(least(floor(rest - before), size), 0) AS BIGINT) AS taken
FROM p
"""
