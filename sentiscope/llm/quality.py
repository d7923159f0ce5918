"""Operator 2: quality rules as a threshold table compiled into one projection.

Measures (words are runs of non-white-space, ASCII white space):

* length: ``n_words``, code points in words, their mean;
* symbols: characters of ``#*$%&|<>`` per word;
* stop words: share of words in a list for four languages, in lower case or capitalised;
* lines: share of lines with a word that equal an earlier line; share of words in
  3-word windows that occur twice or more.

:data:`RULES` holds ``(name, measure, least, most)``; :func:`rules_failed` compiles it
into one expression, and a document is kept if no bound is broken.  All measures are
built-in expressions over arrays of the row itself: no shuffle, no user function.
Repeated windows come from a sorted array of window hashes, so the work is
``n log n`` in the words of a text, however often a window repeats.

Defined results: a null or empty text has no words, all counts 0, and fails the
base rule; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import SYMBOLS, fresh_name, symbol_count, text_or_empty, word_array

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with be by this from or an at not have "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "le la les de des du et en un une que qui dans est pour pas sur au par plus ne ce il se avec sont aux ou "
    "el los las y del se por con una su para es lo como más pero sus al o este sí porque esta entre cuando muy"
).split()
# as written inside and at the start of a sentence
STOP_FORMS = tuple(dict.fromkeys(form for w in STOP_WORDS for form in (w, w[0].upper() + w[1:])))

# (rule, measure, least, most); None is no bound.
RULES = (
    ("word_length", "mean_word_chars", 2.0, 15.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("stop_words", "stop_ratio", 0.02, None),
    ("repeated_lines", "dup_line_ratio", None, 0.5),
)


def _windows(hashes: Column) -> Column:
    """Hash of each 3-word window, from the words' hashes."""
    n = F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))
    two = F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.zip_with(two, F.slice(hashes, 3, n), lambda a, b: F.xxhash64(a, b))


def _pairs(array: Column, combine) -> Column:
    """``combine`` over neighbouring elements."""
    n = F.greatest(F.size(array) - 1, F.lit(0))
    return F.zip_with(F.slice(array, 1, n), F.slice(array, 2, n), combine)


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio")


def measures(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus one column per measure, and the name each measure got (longer if taken).

    Every array that is used more than once is a column of its own, so the optimiser
    keeps it as a separate projection and computes it once per row.
    """
    stems = ("_t", "_words", "_lines", "_hashes", "_windows", "_order", "_repeated", "_n_lines", "_n_stops")
    names = {stem: fresh_name(docs, stem) for stem in stems + MEASURES}
    t, words, lines, hashes, windows, order, repeated, n_lines, n_stops = (names[s] for s in stems)
    c = F.col
    step = docs.withColumn(t, text_or_empty(text_col))
    step = step.withColumns({
        words: word_array(c(t)),
        lines: F.filter(F.split(c(t), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
    })
    step = step.withColumn(hashes, F.transform(c(words), lambda w: F.xxhash64(w)))
    step = step.withColumn(windows, _windows(c(hashes)))
    # places of windows found twice or more; the sort, by all bits of the hash and the place, runs only where there are any
    several = F.size(F.array_distinct(c(windows))) < F.size(c(windows))
    step = step.withColumn(order, F.when(several, F.sort_array(
        F.transform(c(windows), lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))))
    twins = _pairs(c(order), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    twins = F.flatten(F.filter(twins, lambda x: x.isNotNull()))
    step = step.withColumn(repeated, F.sort_array(F.array_distinct(twins)))
    covered = F.when(F.size(c(repeated)) > 0, _total(_pairs(c(repeated), lambda a, b: F.least(b - a, F.lit(WINDOW).cast("long")))) + WINDOW)
    step = step.withColumns({
        names["n_words"]: F.size(c(words)).cast("long"),
        names["word_chars"]: F.length(F.array_join(c(words), "")).cast("long"),
        names["n_symbols"]: symbol_count(c(t)),
        names["n_repeat_words"]: F.coalesce(covered, F.lit(0)).cast("long"),
        n_lines: F.size(c(lines)).cast("long"),
        names["n_dup_lines"]: (F.size(c(lines)) - F.size(F.array_distinct(c(lines)))).cast("long"),
        n_stops: F.size(F.filter(c(words), lambda w: w.isin(*STOP_FORMS))),
    })

    def ratio(a, b):
        return F.when(c(b) > 0, c(a) / c(b)).otherwise(F.lit(0.0))

    step = step.withColumns({
        names["mean_word_chars"]: ratio(names["word_chars"], names["n_words"]),
        names["symbol_ratio"]: ratio(names["n_symbols"], names["n_words"]),
        names["stop_ratio"]: ratio(n_stops, names["n_words"]),
        names["dup_line_ratio"]: ratio(names["n_dup_lines"], n_lines),
    })
    return step.drop(*(names[s] for s in stems)), {m: names[m] for m in MEASURES}


def base_failed(m: dict[str, str]) -> Column:
    words = F.col(m["n_words"])
    return (words < MIN_WORDS) | (100 * F.col(m["n_repeat_words"]) > MAX_REPEAT_PERCENT * words)


def rules_failed(m: dict[str, str], rules=RULES) -> Column:
    """The threshold table as one Boolean, true where any bound is broken."""
    broken = F.lit(False)
    for _, measure, least, most in rules:
        if least is not None:
            broken = broken | (F.col(m[measure]) < least)
        if most is not None:
            broken = broken | (F.col(m[measure]) > most)
    return broken


def judge(docs: DataFrame, text_col: str = "text", rules=RULES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` plus the measures, ``base_failed`` and ``kept``, and the name each got."""
    step, m = measures(docs, text_col)
    m = m | {"base_failed": fresh_name(step, "base_failed"), "kept": fresh_name(step, "kept")}
    return step.withColumns({m["base_failed"]: base_failed(m), m["kept"]: ~(base_failed(m) | rules_failed(m, rules))}), m


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows that no rule rejects, with their own columns only."""
    judged, m = judge(docs, text_col, rules)
    # the row mark keeps the filter above the projections; pushed below, it would repeat their expressions
    mark = fresh_name(judged, "_mark")
    judged = judged.withColumn(mark, F.monotonically_increasing_id())
    return judged.where(F.col(m["kept"]) & (F.col(mark) >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])


def _measures_sql() -> str:
    stop = ", ".join("'" + w + "'" for w in STOP_FORMS)
    return f"""
WITH w AS (
  SELECT doc_id, COALESCE(text, '') AS t,
         regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         row_number() OVER () AS r
  FROM documents),
g AS (SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS win
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
f AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1),
v AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM f) GROUP BY r),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(v.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(words, lambda x: x IN ({stop}))) AS stops
  FROM w LEFT JOIN v USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
"""


def _rules_sql() -> str:
    exact = {"mean_word_chars": "word_chars / n_words", "symbol_ratio": "n_symbols / n_words",
             "stop_ratio": "stops / n_words", "dup_line_ratio": "n_dup_lines / n_lines"}
    tests = []
    for _, measure, least, most in RULES:
        if least is not None:
            tests.append(f"{exact[measure]} < {least}")
        if most is not None:
            tests.append(f"{exact[measure]} > {most}")
    return " OR ".join(tests)


QUALITY_SQL = _measures_sql() + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_rules_sql()}) AS kept
FROM b
"""
