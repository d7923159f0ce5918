"""Probability-vector expressions over ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def confidence(probability) -> Column:
    """Max class probability; null for a null or empty array."""
    return F.array_max(_col(probability))


def probability_values(probability) -> Column:
    """Each probability at 4 decimals joined by `` | ``; ``""`` when null or empty."""
    p = _col(probability)
    formatted = F.array_join(F.transform(p, lambda x: F.format_string("%.4f", x)), " | ")
    return F.coalesce(formatted, F.lit(""))


def as_double_array(probability) -> Column:
    """ML probability vector -> ``array<double>``; null -> empty array."""
    from pyspark.ml.functions import vector_to_array

    return F.coalesce(vector_to_array(_col(probability)), F.array().cast("array<double>"))


def percent(value, digits: int = 2) -> Column:
    """``round(value * 100, digits)`` in double arithmetic."""
    return F.round(_col(value).cast("double") * F.lit(100.0), digits)
