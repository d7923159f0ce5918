"""Parquet scans of the driver tables.

Every scan is lazy: Catalyst prunes columns and pushes filters into the Parquet
reader, so callers only pay for the columns they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one driver table."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """The Spark application and the files of the tables (path, size, time): a key for kept results."""
    found = [spark.sparkContext.applicationId]
    for name in names:
        files = table(spark, sf_dir, name).select(
            F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("h")).distinct()
        found += [name, *files.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()]
    return tuple(found)


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver tables as temp views (for ``spark.sql``)."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
