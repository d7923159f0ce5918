"""Lexicon inputs of the lemmatiser: known base forms and irregular forms.

A folder in WordNet's database format has both: ``index.noun`` (a line per lemma, which is its first
field; licence lines begin with a space) and ``noun.exc`` (an irregular form and its lemmas on a line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEXICON = "word string"
EXCEPTIONS = "form string, place int, lemma string"


def read_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """``word``: the base forms of ``index.noun``."""
    lines = spark.read.text(f"{folder.rstrip('/')}/index.noun").where(~F.col("value").startswith(" "))
    return lines.select(F.split("value", " ")[0].alias("word")).where("word != ''")


def read_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    """``form, place, lemma``: the irregular forms of ``noun.exc`` with their lemmas in order (place from 1)."""
    fields = F.split(F.trim("value"), " +")
    return (spark.read.text(f"{folder.rstrip('/')}/noun.exc")
            .select(fields[0].alias("form"), F.posexplode(F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0)))).alias("place", "lemma"))
            .select("form", (F.col("place") + 1).alias("place"), "lemma"))
