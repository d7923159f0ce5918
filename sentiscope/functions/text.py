"""Text column expressions: cleaning chain, tokens, stop words, bigrams.

Everything here is a built-in Spark expression (regex, ``split``, higher-order
``filter`` / ``transform``) and runs inside whole-stage code generation - no
Python UDF touches the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NLTK English stop-word list (classic 179-word release) plus "im",
# as used by the original cleaning function.  Entries with an apostrophe can never
# match a cleaned token (punctuation is deleted first) but are kept for fidelity.
NLTK_ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()
CLEAN_STOPWORDS = tuple(NLTK_ENGLISH_STOPWORDS) + ("im",)

# The white space of the original's text handling, every Unicode space among it (plain
# characters, so that Java's and RE2's regular expressions agree): tab to carriage return, the four separators,
# space, next line, no-break space, ogham space, the spaces of General Punctuation, line and paragraph
# separator, narrow no-break, mathematical and ideographic space.
WS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                       0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
TOKEN_SPLIT = "\\W+"

# Spark ML's default English stop-word list (what ``StopWordsRemover`` loads).
SPARK_ENGLISH_STOPWORDS = tuple((
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she "
    "her hers herself it its itself they them their theirs themselves what which who whom this that "
    "these those am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again further then once here "
    "there when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll "
    "i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've "
    "they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't "
    "shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's "
    "what's when's where's who's why's would"
).split())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_tokens(text, stopwords=CLEAN_STOPWORDS) -> Column:
    """lower -> delete all but ``[a-z]`` and (Unicode) whitespace -> split -> drop stop words.

    Deleting (not spacing) punctuation glues words (``good,bad`` -> ``goodbad``)
    and turns ``don't`` into ``dont``, exactly as the original chain does.
    A non-string / null text gives an empty array.
    """
    t = F.coalesce(_col(text), F.lit(""))
    # one kind of white space first: the class to delete and the split then stay plain and fast
    spaced = F.translate(F.lower(t), WS, " " * len(WS))
    parts = F.split(F.regexp_replace(spaced, "[^a-z ]+", ""), " ")
    # isin over many literals plans as a hash-set lookup (InSet), not a list scan
    return F.filter(parts, lambda w: (F.length(w) >= 1) & ~w.isin(*stopwords))


def clean_text(text, stopwords=CLEAN_STOPWORDS) -> Column:
    """The cleaning chain without lemmatisation, tokens joined by one space."""
    return F.array_join(clean_tokens(text, stopwords), " ")


def tokenize(text) -> Column:
    """``RegexTokenizer(pattern='\\W+', toLowercase=True)`` as an expression."""
    return F.filter(F.split(F.lower(_col(text)), TOKEN_SPLIT), lambda w: F.length(w) >= 1)


def remove_stopwords(tokens, stopwords=None) -> Column:
    """``StopWordsRemover`` with Spark's default English list (case-insensitive)."""
    stop = stopwords or SPARK_ENGLISH_STOPWORDS
    return F.filter(_col(tokens), lambda w: ~F.lower(w).isin(*stop))


def bigrams(tokens) -> Column:
    """``NGram(n=2)``: adjacent pairs joined by a space; fewer than 2 tokens -> ``[]``.

    Written with ``zip_with`` over two slices so the token array is never
    referenced inside a lambda: after projection collapsing such a reference
    would recompute the whole token expression once per element.
    """
    t = _col(tokens)
    n = F.greatest(F.size(t) - F.lit(1), F.lit(0))
    return F.zip_with(F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def sql_string_list(words) -> str:
    """DuckDB list literal of strings."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
