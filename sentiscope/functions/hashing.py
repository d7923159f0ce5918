"""Deterministic per-row uniform numbers.

``rand(seed)`` depends on how rows are partitioned, so a split or sample drawn
with it changes when the input is repartitioned.  A hash of the row key does
not: ``hash_fraction`` maps a key to a uniform number in [0, 1) from the first
32 bits of ``md5(seed:key)`` - the same value in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_fraction(key, seed: int = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def hash_fraction_sql(key_sql: str, seed: int = 42) -> str:
    """DuckDB twin of :func:`hash_fraction`."""
    return (f"(CAST(('0x' || substring(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / {TWO_POW_32})")
