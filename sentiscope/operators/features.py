"""Relational text features: term statistics, vocabulary, IDF, TF-IDF, label index.

These are the relational twins of the Spark ML stages (``CountVectorizer``,
``IDF``, ``StringIndexer``) plus the smooth-IDF / L2-normalised TF-IDF of the
experiments.  Documents are exploded to ``(doc, term)`` rows; every statistic is
a partial + final hash aggregation, so a term that occurs in every document is
combined map-side before the shuffle.  The only bounded-size pieces are the
vocabulary (at most ``vocab_size`` rows, a parameter) and the label table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# WordNet's noun detachment rules (suffix -> replacement), in rule order.
NOUN_RULES = (("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
              ("shes", "sh"), ("men", "man"), ("ies", "y"))


def explode_terms(docs: DataFrame, doc: str, tokens: str, alias: str = "term") -> DataFrame:
    """``(doc, term)`` rows of a token-array column.

    ``explode_outer`` + a null filter instead of ``explode``: for ``explode`` the
    optimizer infers ``size(tokens) > 0`` and pushes it below the projection,
    which inlines (and so recomputes) the whole tokenisation expression in the
    scan filter.
    """
    return docs.select(doc, F.explode_outer(tokens).alias(alias)).where(F.col(alias).isNotNull())


def doc_terms(docs: DataFrame, doc: str, tokens: str) -> DataFrame:
    """``(doc, term, tf)``: per-document term counts."""
    return (explode_terms(docs, doc, tokens)
            .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_stats(terms: DataFrame) -> DataFrame:
    """``term, tf`` (total count), ``df`` (documents containing it) from ``doc_terms``."""
    return terms.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


def term_stats_from_tokens(docs: DataFrame, tokens: str) -> DataFrame:
    """``term, tf, df`` straight from token arrays, without a ``(doc, term)`` shuffle.

    A document's tokens are one row, so each row emits ``(term, 1, 0)`` per token
    and ``(term, 0, 1)`` per distinct token; one ``groupBy(term)`` sums them.
    Partial aggregation runs before the shuffle, which then carries one partial
    row per term per task instead of one row per (document, term) pair.  The
    token column is referenced only outside the lambdas, so it is computed once.
    """
    t = F.col(tokens)
    occ = F.transform(t, lambda x: F.struct(x.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df")))
    dst = F.transform(F.array_distinct(t), lambda x: F.struct(x.alias("term"), F.lit(0).alias("tf"),
                                                              F.lit(1).alias("df")))
    rows = docs.select(F.explode_outer(F.concat(occ, dst)).alias("e")).where(F.col("e").isNotNull())
    return (rows.groupBy(F.col("e.term").alias("term"))
            .agg(F.sum("e.tf").cast("bigint").alias("tf"), F.sum("e.df").cast("bigint").alias("df")))


def term_stats_from_stored(docs: DataFrame, tokens: str) -> DataFrame:
    """``term, tf, df`` as :func:`term_stats_from_tokens`, of a stored token column.

    Reading it twice is cheap, so tokens and distinct tokens are exploded as they are, without
    a structure per token.
    """
    occ = docs.select(F.explode(tokens).alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))
    dst = docs.select(F.explode(F.array_distinct(tokens)).alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))
    return (occ.union(dst).where(F.col("term").isNotNull()).groupBy("term")
            .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))


def vocabulary(terms: DataFrame, vocab_size: int, min_df: float = 1.0, n_docs=None,
               stats: DataFrame | None = None) -> DataFrame:
    """Top ``vocab_size`` terms by total count among terms with ``df >= min_df``.

    ``min_df`` below 1 is a fraction of the documents (as in ``CountVectorizer``).
    Ties in total count are broken by term so the cut is deterministic.  Output
    ``term, tf, df, term_index`` (0-based).  The ordered ``limit`` keeps at most
    ``vocab_size`` rows per task; the index window then runs over the bounded
    vocabulary only.
    """
    stats = stats if stats is not None else term_stats(terms)
    if min_df < 1.0:
        if n_docs is None:
            raise ValueError("a fractional min_df needs n_docs")
        threshold = F.lit(min_df) * n_docs
    else:
        threshold = F.lit(float(min_df))
    top = (stats.where(F.col("df") >= threshold)
           .orderBy(F.col("tf").desc(), F.col("term").asc()).limit(vocab_size))
    return top.withColumn("term_index", F.row_number().over(
        Window.orderBy(F.col("tf").desc(), F.col("term").asc())) - F.lit(1))


def term_counts(terms: DataFrame, vocab: DataFrame, doc: str) -> DataFrame:
    """Sparse count vectors in long form: ``doc, term_index, term, count`` (vocabulary terms only).

    The vocabulary is at most ``vocab_size`` rows, so it is broadcast.
    """
    v = F.broadcast(vocab.select("term", "term_index"))
    return terms.join(v, "term", "inner").select(doc, "term_index", "term", F.col("tf").alias("count"))


def idf(vocab: DataFrame, n_docs) -> DataFrame:
    """Spark ML IDF: ``ln((N + 1) / (df + 1))`` per vocabulary term."""
    return vocab.select("term", "term_index", "df",
                        F.log((F.lit(n_docs).cast("double") + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(terms: DataFrame, idf_table: DataFrame, doc: str) -> DataFrame:
    """``tf * idf`` per (doc, vocabulary term), from ``doc_terms`` in one broadcast join.

    The idf table has one row per vocabulary term (at most ``vocab_size``), so
    restricting to the vocabulary and weighting happen in the same join.
    """
    w = F.broadcast(idf_table.select("term", "term_index", "idf"))
    return terms.join(w, "term", "inner").select(
        doc, "term_index", "term", (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf_smooth_l2(docs: DataFrame, doc: str, tokens: str) -> DataFrame:
    """Smooth IDF ``ln((1 + N) / (1 + df)) + 1``, raw counts, each document L2-normalised.

    Vocabulary = every term (no frequency cut).  Output ``doc, term, weight``.
    The texts are tokenised once: the counts per (document, term) feed the document
    frequencies (partial sums per term, so a frequent term is no hot key there) and, in one join by term, the
    weights.  A document's distinct terms are then one row: its norm sums the squares in ascending order, so the
    result does not depend on the order rows arrive after a shuffle, and needs no second join.
    """
    terms = doc_terms(docs, doc, tokens)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    dfs = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.col("tf") * (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))
    per_doc = (terms.join(dfs, "term").groupBy(doc)
               .agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("_terms")))
    squares = F.array_sort(F.transform("_terms", lambda t: t["w"] * t["w"]))
    normed = per_doc.select(doc, "_terms", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)).alias("_norm"))
    return (normed.select(doc, "_norm", F.inline("_terms"))
            .select(doc, "term", (F.col("w") / F.col("_norm")).alias("weight")))


def label_index_table(frame: DataFrame, label: str = "label") -> DataFrame:
    """``StringIndexer`` order: most frequent label first, ties alphabetical.

    The window runs over the aggregated label table (one row per label).
    """
    counts = frame.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    w = Window.orderBy(F.col("count").desc(), F.col(label).asc())
    return counts.withColumn("label_index", (F.row_number().over(w) - F.lit(1)).cast("double"))


# ------------------------------------------------------------ lemmatisation
def _detached(forms: Column) -> Column:
    """Every rule applied to every form that ends in its suffix, in the order of forms and rules."""
    def cut(form: Column) -> Column:
        results = [F.when(form.endswith(suffix), F.concat(F.substring(form, F.lit(1), F.length(form) - len(suffix)), F.lit(base)))
                   for suffix, base in NOUN_RULES]
        return F.filter(F.array(*results), lambda x: x.isNotNull())

    return F.array_distinct(F.flatten(F.transform(forms, cut)))


def noun_candidates(words: DataFrame, term: str = "term") -> DataFrame:
    """``term, level, place, cand``: base forms that the detachment rules give, level by level.

    Level 1 has the word itself and its rules' results; a further level has the rules'
    results of the level before.  Only trailing ``e`` and ``s`` letters, and one more ending
    behind them, can be detached, so their number bounds the levels.
    """
    levels = F.length(F.regexp_extract(term, "[es]*$", 0)) + F.lit(1)
    none = F.array().cast("array<struct<level:int,place:int,cand:string>>")

    def step(acc: Column, level: Column) -> Column:
        forms = _detached(acc["forms"])
        found = F.transform(forms, lambda c, i: F.struct(level.cast("int").alias("level"), (i + 1).cast("int").alias("place"), c.alias("cand")))
        return F.struct(forms.alias("forms"), F.concat(acc["found"], found).alias("found"))

    start = F.struct(F.array(F.col(term)).alias("forms"), none.alias("found"))
    found = F.aggregate(F.sequence(F.lit(1), levels), start, step, lambda acc: acc["found"])
    own = F.array(F.struct(F.lit(1).alias("level"), F.lit(0).alias("place"), F.col(term).alias("cand")))
    return words.select(term, F.inline(F.concat(own, found)))


def noun_lemma_table(words: DataFrame, lexicon: DataFrame | None = None, exceptions: DataFrame | None = None,
                     term: str = "term") -> DataFrame:
    """``term, lemma`` of the words that have another form as noun lemma (all other words are their own).

    ``lexicon`` (``word``) holds the known base forms, ``exceptions`` (``form, place, lemma``) the irregular forms;
    both are inputs, for instance WordNet's noun index and exception list (``sources.lexicon``).  A form of the exception list has
    itself and its listed lemmas as candidates, any other word those of the detachment rules: the
    first level that has a word of the lexicon counts.  Of the candidates in the lexicon the shortest wins, the first of equal
    ones.  Without a lexicon the words themselves are it.
    """
    distinct = words.select(F.col(term).alias("term")).where(F.col("term").isNotNull()).distinct()
    known = distinct.select(F.col("term").alias("cand")) if lexicon is None else lexicon.select(F.col("word").alias("cand")).distinct()
    cands = noun_candidates(distinct)
    if exceptions is not None:
        irregular = exceptions.select(F.col("form").alias("term"), F.lit(1).alias("level"), "place", F.col("lemma").alias("cand"))
        own = cands.where("level = 1 and place = 0")
        listed = irregular.unionByName(own.join(irregular, "term", "left_semi")).join(distinct, "term", "left_semi")
        cands = cands.join(irregular, "term", "left_anti").unionByName(listed)
    order = F.struct("level", F.length("cand"), "place")
    return (cands.join(known, "cand", "left_semi").groupBy("term").agg(F.min_by("cand", order).alias("lemma"))
            .where(F.col("lemma") != F.col("term")))


def changed_tokens(docs: DataFrame, doc: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """``doc, lemma_of``: per document a map of its tokens that have another lemma; documents without one are left out.

    ``lemmas`` is a dictionary with a row per word that changes.  Stored, its size is known to the planner, which broadcasts it
    when it is small enough: then no token is shuffled.  Beyond that each document sends a token once, and
    the adaptive skew join splits a token of very many documents (the dictionary has one row for it).
    """
    lem = lemmas.select(F.col("term").alias("token"), "lemma")
    seen = explode_terms(docs.select(doc, F.array_distinct(tokens).alias("_seen")), doc, "_seen", "token")
    return (seen.join(lem, "token").groupBy(doc)
            .agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("lemma_of")))


def lemma_arrays(docs: DataFrame, doc: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """``doc, tokens, lemmas``: each token's lemma in place; ``doc`` is unique."""
    changes = changed_tokens(docs, doc, tokens, lemmas)
    rewritten = F.transform(F.col(tokens), lambda w: F.coalesce(F.try_element_at("lemma_of", w), w))
    return docs.join(changes, doc, "left").select(
        doc, F.col(tokens).alias("tokens"), F.when(F.col("lemma_of").isNull(), F.col(tokens)).otherwise(rewritten).alias("lemmas"))


def lemmatize_tokens(docs: DataFrame, doc: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Every token with its lemma, in order: ``doc, pos, token, lemma``."""
    pairs = lemma_arrays(docs, doc, tokens, lemmas).select(
        doc, F.arrays_zip(F.col("tokens").alias("token"), F.col("lemmas").alias("lemma")).alias("_t"))
    return pairs.select(doc, F.posexplode("_t").alias("pos", "_e")).select(doc, "pos", "_e.token", "_e.lemma")


def lemmatized_texts(docs: DataFrame, doc: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """``doc, clean_text``: the lemmas of each document, joined by spaces."""
    return lemma_arrays(docs, doc, tokens, lemmas).select(doc, F.array_join("lemmas", " ").alias("clean_text"))
