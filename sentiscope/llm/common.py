"""Shared pieces of the training-data operators: scans, words, hashes, scratch tables."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiscope.session import scratch_path

# ASCII white space of the word definition, and its complement.
SPACES = " \t\n\x0b\f\r"
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
TWO_POW_52 = 4503599627370496.0


def ship(module: str) -> None:
    """Send the module's functions to the executors by value, so that these need no copy of the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def scan(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Pruned Parquet scan of one given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(text: Column, characters: str) -> Column:
    """``text`` with every occurrence of the given characters deleted."""
    return F.translate(text, characters, "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_array(text: Column) -> Column:
    """All words in order: other white space becomes a space, and empty pieces go."""
    return F.array_remove(F.split(F.regexp_replace(text, "[\\x09-\\x0D]", " "), " "), "")


def symbol_count(text: Column) -> Column:
    """Characters of ``SYMBOLS``; the deletion runs only where the text has any."""
    found = F.length(text) - F.length(without(text, SYMBOLS))
    return F.when(text.rlike(f"[{SYMBOLS}]"), found).otherwise(F.lit(0)).cast("long")


def unit_hash(key: Column, seed: int) -> Column:
    """Uniform number in (0, 1) from 52 bits of ``md5(seed:key)``; the same on every rerun."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(TWO_POW_52)


def unit_hash_sql(key: str, seed: int) -> str:
    """DuckDB twin of :func:`unit_hash`."""
    return (f"((CAST(('0x' || substring(md5('{seed}:' || COALESCE(CAST({key} AS VARCHAR), 'null')), 1, 13)) AS BIGINT)"
            f" + 0.5) / {TWO_POW_52})")


def materialise(df: DataFrame, kind: str = "step") -> DataFrame:
    """Cut the lineage: write a table into the shared folder that the cluster names, and read it.

    Executors can be lost without a recomputation, later scans prune columns, and the
    planner sees the table's true size.
    """
    path = scratch_path(df.sparkSession, f"{kind}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128-bit digest that stands for a text in joins; a result that depends on the text alone joins by it."""
    return F.md5(text)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
