"""Label expressions: rating -> class, prediction index -> class name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class names and the rating thresholds of the labelling rule.
NEGATIVE, NEUTRAL, POSITIVE, UNKNOWN = "negative", "neutral", "positive", "unknown"
CLASSES = (POSITIVE, NEGATIVE, NEUTRAL)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def score_to_label(score) -> Column:
    """Rating 1-5 -> ``negative`` (<3), ``neutral`` (=3), ``positive`` (else).

    Apply to a validated integer column (see ``operators.prepare.clean_reviews``);
    a null rating falls into ``positive`` exactly as the original rule does.
    """
    s = _col(score)
    return F.when(s < 3, F.lit(NEGATIVE)).when(s == 3, F.lit(NEUTRAL)).otherwise(F.lit(POSITIVE))


def score_to_label_or_unknown(score) -> Column:
    """As ``score_to_label`` but a null rating maps to ``unknown``."""
    s = _col(score)
    return F.when(s.isNull(), F.lit(UNKNOWN)).otherwise(score_to_label(s))


def decode_prediction(prediction, labels) -> Column:
    """Prediction index (double) -> class name via the indexer label order.

    Index ``i`` reads element ``i`` of the label array; a null, fractional, NaN or
    out-of-range index reads nothing and becomes ``unknown``.
    """
    p = _col(prediction)
    names = F.array(*[F.lit(name) for name in labels]).cast("array<string>")
    whole = F.when(p == F.floor(p), p.cast("int"))
    return F.coalesce(F.get(names, whole), F.lit(UNKNOWN))
