"""Report tables (executive summary and batch summary sections) as DataFrames.

The original renders these into a PDF; here they are plain string tables that a
caller can write as CSV / Parquet.  Every value is computed on Spark in one
aggregation pass over the analytics frame (plus the exact median, see
``operators.stats``); only the formatting happens in column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiscope.operators import monitor
from sentiscope.operators.stats import value_counts


def _pct_or_na(value: Column) -> Column:
    return F.coalesce(F.format_string("%.2f%%", value * F.lit(100.0)), F.lit("N/A"))


def _thousands(value: Column) -> Column:
    return F.format_number(value.cast("bigint"), 0)


def report_summary(frame: DataFrame, counts: DataFrame | None = None, batches: DataFrame | None = None) -> DataFrame:
    """Rows ``(section, position, metric, value)`` of report sections 3 and 8.

    Lazy.  ``counts`` (value counts of the confidence) and ``batches`` (records per batch)
    come from ``frame`` unless they are given, for instance from the store's rollups.
    """
    totals = monitor.confidence_totals(value_counts(frame, "confidence") if counts is None else counts)
    batches = monitor.batch_summary(frame) if batches is None else batches
    low_label = f"Low-confidence predictions below {monitor.LOW_CONFIDENCE_THRESHOLD * 100:.0f}%"
    execu = totals.select(
        _thousands(F.col("total")).alias("total"),
        _pct_or_na(F.col("average")).alias("avg"),
        _pct_or_na(F.col("median")).alias("median"),
        _pct_or_na(F.col("least")).alias("min"),
        _pct_or_na(F.col("greatest")).alias("max"),
        _thousands(F.col("low")).alias("low"),
    )
    execu_rows = execu.selectExpr(
        "stack(6, 1, 'Total predictions', total, 2, 'Average confidence', avg, "
        "3, 'Median confidence', median, 4, 'Minimum confidence', min, "
        f"5, 'Maximum confidence', max, 6, '{low_label}', low) AS (position, metric, value)"
    ).withColumn("section", F.lit("executive_summary"))
    k = monitor.batch_kpis(batches)
    kpi = k.select(
        _thousands(F.col("total_batches")).alias("b"),
        _thousands(F.col("total_records")).alias("r"),
        F.format_string("%.2f", F.col("avg_records_per_batch")).alias("a"),
        _thousands(F.col("min_records_per_batch")).alias("mn"),
        _thousands(F.col("max_records_per_batch")).alias("mx"),
        F.coalesce(F.col("latest_batch_id").cast("string"), F.lit("N/A")).alias("l"),
    )
    kpi_rows = kpi.selectExpr(
        "stack(6, 1, 'Total micro-batches', b, 2, 'Total records', r, "
        "3, 'Average records per micro-batch', a, 4, 'Minimum records in one micro-batch', mn, "
        "5, 'Maximum records in one micro-batch', mx, 6, 'Latest batch ID', l) AS (position, metric, value)"
    ).withColumn("section", F.lit("streaming_batch_summary"))
    return (execu_rows.unionByName(kpi_rows)
            .select("section", F.col("position").cast("int"), "metric", "value"))


def select_existing(frame: DataFrame, columns) -> DataFrame:
    """Keep only the requested columns that the frame has (schema-tolerant projection)."""
    return frame.select(*[c for c in columns if c in frame.columns])


def report_table(frame: DataFrame, columns=None, max_rows: int = 20, order=None) -> DataFrame:
    """A report table: optional column subset, every cell as a string, first ``max_rows`` rows.

    ``order`` (columns or Column expressions) fixes which rows are first; the
    limit is the feature of a report table, not a way to cut work.
    """
    keep = [c for c in columns if c in frame.columns] if columns is not None else frame.columns
    if order is not None:
        frame = frame.orderBy(*order)
    return frame.limit(max_rows).select(*[F.col(c).cast("string").alias(c) for c in keep])


def report_tables(analytics: DataFrame, latest: DataFrame) -> dict[str, DataFrame]:
    """All data tables of the report, keyed by section name."""
    from sentiscope.operators import monitor as M

    low = M.low_confidence(analytics).withColumn("confidence", F.round(F.col("confidence") * 100.0, 2))
    return {
        "summary": report_summary(analytics),
        "sentiment_distribution": report_table(M.sentiment_summary(analytics), max_rows=10),
        "score_distribution": report_table(M.score_distribution(analytics), max_rows=10),
        "confidence_by_sentiment": report_table(M.confidence_by_sentiment(analytics), max_rows=10),
        "score_by_sentiment": report_table(M.score_sentiment_crosstab(analytics), max_rows=20),
        "latest_batches": report_table(M.batch_summary(analytics), max_rows=10,
                                       order=[F.col("batch_id").desc()]),
        "low_confidence_samples": report_table(
            low, ["processed_at", "score", "predicted_label", "confidence", "batch_id"], 20,
            order=list(M.latest_order())),
        "latest_predictions": report_table(
            latest.withColumn("text_preview", F.substring("text_preview", 1, 90)),
            ["processed_at", "text_preview", "score", "predicted_label", "confidence_pct", "batch_id"], 20,
            order=list(M.latest_order())),
    }


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """Each report table as a CSV folder with header (all tables are row-bounded)."""
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/{name}")
