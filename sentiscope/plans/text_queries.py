"""Registered text-feature queries over the review texts (``labelled``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentiscope.catalog import register
from sentiscope.functions import text as X
from sentiscope.operators import features as FE
from sentiscope.operators import prepare as P
from sentiscope.plans.prepare_queries import SPLIT_SQL
from sentiscope.session import stored
from sentiscope.sources.fixtures import labelled

# Final configuration of the original search (vocabulary size, min document frequency).
VOCAB_SIZE, MIN_DF = 10_000, 4

# Python's white space in RE2's own classes
WS_SQL = r"\s\pZ\x0B\x1C-\x1F\x{85}"
CLEAN_SQL = (f"list_filter(regexp_split_to_array(regexp_replace(lower(COALESCE(text, '')), "
             f"'[^a-z{WS_SQL}]', '', 'g'), '[{WS_SQL}]+'), "
             f"lambda w: length(w) >= 1 AND NOT list_contains({X.sql_string_list(X.CLEAN_STOPWORDS)}, w))")
TOKENS_SQL = "list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda x: length(x) >= 1)"


def _filtered_sql(tokens_sql: str) -> str:
    stop = X.sql_string_list(X.SPARK_ENGLISH_STOPWORDS)
    return f"list_filter({tokens_sql}, lambda w: NOT list_contains({stop}, lower(w)))"


def _bigrams_sql(t: str) -> str:
    return f"list_transform(range(len({t}) - 1), lambda i: {t}[i + 1] || ' ' || {t}[i + 2])"


def _filtered(spark, sf):
    lab = labelled(spark, sf)
    return lab.select("doc_id", X.remove_stopwords(X.tokenize("text")).alias("tokens"))


def _stop_sql() -> str:
    return f"toks AS (SELECT doc_id, {_filtered_sql(TOKENS_SQL)} AS t FROM labelled)"


# the vocabulary comes from the statistics of the training split; every document is then counted by it
TERMS_SQL = f"""
dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM toks) u GROUP BY doc_id, term),
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM dt
       WHERE doc_id IN (SELECT doc_id FROM labelled WHERE {SPLIT_SQL} = 'train') GROUP BY term)
"""
VOCAB_SQL = f"""
voc AS (SELECT term, tf, df, CAST(row_number() OVER (ORDER BY tf DESC, term ASC) - 1 AS INTEGER) AS term_index
        FROM st WHERE df >= {float(MIN_DF)} ORDER BY tf DESC, term ASC LIMIT {VOCAB_SIZE})
"""
N_TRAIN_SQL = f"CAST((SELECT count(*) FROM labelled WHERE {SPLIT_SQL} = 'train') AS DOUBLE)"


def _train_tokens(spark, sf):
    train, _, _ = P.split_frames(labelled(spark, sf))
    return train.select("doc_id", X.remove_stopwords(X.tokenize("text")).alias("tokens"))


def _vocab(spark, sf):
    """Vocabulary of the training split."""
    vocab = FE.vocabulary(None, VOCAB_SIZE, MIN_DF, stats=FE.term_stats_from_tokens(_train_tokens(spark, sf), "tokens"))
    return vocab.withColumn("term_index", F.col("term_index").cast("int"))


def _n_train(spark, sf):
    train, _, _ = P.split_frames(labelled(spark, sf).select("doc_id"))
    return train.select(F.count(F.lit(1))).scalar()


@register("clean_text", f"""
SELECT doc_id, array_to_string({CLEAN_SQL}, ' ') AS clean_text FROM labelled
""", ("labelled",))
def q_clean_text(spark, sf):
    return labelled(spark, sf).select("doc_id", X.clean_text("text").alias("clean_text"))


RULES_SQL = ", ".join(f"({i + 1}, '{s}', '{r}')" for i, (s, r) in enumerate(FE.NOUN_RULES))
# The lexicon inputs are derived from the corpus: its words are the known base forms, and its words on -aux
# are the irregular forms, of lemmas on -al and -ail.
LEMMA_SQL = f"""
ct AS (SELECT doc_id, {CLEAN_SQL} AS t FROM labelled),
words AS (SELECT DISTINCT unnest(t) AS term FROM ct),
exc AS (SELECT term AS form, 1 AS place, substring(term, 1, length(term) - 3) || 'al' AS lemma FROM words WHERE suffix(term, 'aux')
        UNION ALL SELECT term, 2, substring(term, 1, length(term) - 3) || 'ail' FROM words WHERE suffix(term, 'aux')),
lex AS (SELECT term AS word FROM words UNION SELECT lemma FROM exc WHERE length(lemma) % 2 = 0),
rules(prio, suffix, repl) AS (VALUES {RULES_SQL}),
steps AS (
  SELECT term, 0 AS level, 0::HUGEINT AS place, term AS cand FROM words WHERE term NOT IN (SELECT form FROM exc)
  UNION ALL
  SELECT s.term, s.level + 1, s.place * 10 + r.prio, substring(s.cand, 1, length(s.cand) - length(r.suffix)) || r.repl
  FROM steps s JOIN rules r ON suffix(s.cand, r.suffix)),
cands AS (
  SELECT term, greatest(level, 1) AS level, place, cand FROM steps
  UNION ALL SELECT form, 1, place, lemma FROM exc
  UNION ALL SELECT DISTINCT form, 1, 0, form FROM exc),
lem AS (SELECT term, first(cand ORDER BY level, length(cand), place) AS lemma FROM cands
        WHERE cand IN (SELECT word FROM lex) GROUP BY term),
pos AS (SELECT doc_id, g.pos - 1 AS pos, t[g.pos] AS token
        FROM ct, LATERAL (SELECT unnest(range(1, len(t) + 1)) AS pos) g)
"""


def _lemma_inputs(spark, sf):
    """Stored tokens, and the stored dictionary of the words that change."""
    docs = stored(labelled(spark, sf).select("doc_id", X.clean_tokens("text").alias("tokens")), "clean-tokens")
    words = FE.explode_terms(docs, "doc_id", "tokens").select("term").distinct()
    stem = F.expr("substring(term, 1, length(term) - 3)")
    irregular = words.where(F.col("term").endswith("aux")).select(
        F.col("term").alias("form"), F.posexplode(F.array(F.concat(stem, F.lit("al")), F.concat(stem, F.lit("ail")))).alias("p", "lemma"))
    exceptions = irregular.select("form", (F.col("p") + 1).alias("place"), "lemma")
    lexicon = words.select(F.col("term").alias("word")).unionByName(
        exceptions.where(F.length("lemma") % 2 == 0).select(F.col("lemma").alias("word")))
    return docs, stored(FE.noun_lemma_table(words, lexicon, exceptions), "lemmas")


@register("lemmatize_tokens", f"""
WITH RECURSIVE {LEMMA_SQL}
SELECT p.doc_id, CAST(p.pos AS INTEGER) AS pos, p.token, COALESCE(l.lemma, p.token) AS lemma
FROM pos p LEFT JOIN lem l ON p.token = l.term
""", ("labelled",))
def q_lemmatize_tokens(spark, sf):
    docs, lemmas = _lemma_inputs(spark, sf)
    return FE.lemmatize_tokens(docs, "doc_id", "tokens", lemmas)


@register("clean_text_lemmatized", f"""
WITH RECURSIVE {LEMMA_SQL}
SELECT ct.doc_id, COALESCE(string_agg(COALESCE(l.lemma, p.token), ' ' ORDER BY p.pos), '') AS clean_text
FROM ct LEFT JOIN pos p ON p.doc_id = ct.doc_id LEFT JOIN lem l ON p.token = l.term
GROUP BY ct.doc_id
""", ("labelled",))
def q_clean_text_lemmatized(spark, sf):
    docs, lemmas = _lemma_inputs(spark, sf)
    return FE.lemmatized_texts(docs, "doc_id", "tokens", lemmas)


@register("tokenize", f"""
SELECT doc_id, array_to_string({TOKENS_SQL}, ' ') AS tokens, len({TOKENS_SQL}) AS n_tokens FROM labelled
""", ("labelled",))
def q_tokenize(spark, sf):
    t = X.tokenize("text")
    return labelled(spark, sf).select("doc_id", F.array_join(t, " ").alias("tokens"),
                                      F.size(t).alias("n_tokens"))


@register("remove_stopwords", f"""
WITH {_stop_sql()}
SELECT doc_id, array_to_string(t, ' ') AS filtered_words, len(t) AS n_filtered FROM toks
""", ("labelled",))
def q_remove_stopwords(spark, sf):
    f = _filtered(spark, sf)
    return f.select("doc_id", F.array_join("tokens", " ").alias("filtered_words"),
                    F.size("tokens").alias("n_filtered"))


@register("bigrams", f"""
WITH {_stop_sql()}
SELECT doc_id, array_to_string({_bigrams_sql('t')}, '|') AS bigrams, len({_bigrams_sql('t')}) AS n_bigrams
FROM toks
""", ("labelled",))
def q_bigrams(spark, sf):
    b = X.bigrams("tokens")
    return _filtered(spark, sf).select("doc_id", F.array_join(b, "|").alias("bigrams"),
                                       F.size(b).alias("n_bigrams"))


@register("term_stats", f"""
WITH {_stop_sql()},
dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM toks) u GROUP BY doc_id, term)
SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM dt GROUP BY term
""", ("labelled",))
def q_term_stats(spark, sf):
    return FE.term_stats_from_tokens(_filtered(spark, sf), "tokens")


@register("vocabulary", f"""
WITH {_stop_sql()}, {TERMS_SQL.strip()}, {VOCAB_SQL.strip()}
SELECT term, tf, df, term_index FROM voc
""", ("labelled",))
def q_vocabulary(spark, sf):
    return _vocab(spark, sf)


@register("bigram_vocabulary", f"""
WITH {_stop_sql()},
bg AS (SELECT doc_id, {_bigrams_sql('t')} AS b FROM toks),
dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(b) AS term FROM bg) u GROUP BY doc_id, term),
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM dt GROUP BY term)
SELECT term, tf, df, CAST(row_number() OVER (ORDER BY tf DESC, term ASC) - 1 AS INTEGER) AS term_index
FROM st WHERE df >= 2.0 ORDER BY tf DESC, term ASC LIMIT {VOCAB_SIZE}
""", ("labelled",))
def q_bigram_vocabulary(spark, sf):
    docs = _filtered(spark, sf).select("doc_id", X.bigrams("tokens").alias("bigrams"))
    stats = FE.term_stats_from_tokens(docs, "bigrams")
    return FE.vocabulary(None, VOCAB_SIZE, 2, stats=stats).withColumn("term_index", F.col("term_index").cast("int"))


@register("term_counts", f"""
WITH {_stop_sql()}, {TERMS_SQL.strip()}, {VOCAB_SQL.strip()}
SELECT dt.doc_id, voc.term_index, dt.term, dt.tf AS count FROM dt JOIN voc ON dt.term = voc.term
""", ("labelled",))
def q_term_counts(spark, sf):
    return FE.term_counts(FE.doc_terms(_filtered(spark, sf), "doc_id", "tokens"), _vocab(spark, sf), "doc_id")


@register("idf", f"""
WITH {_stop_sql()}, {TERMS_SQL.strip()}, {VOCAB_SQL.strip()}
SELECT term, term_index, df, round(ln(({N_TRAIN_SQL} + 1.0) / (df + 1.0)), 12)
       AS idf FROM voc
""", ("labelled",))
def q_idf(spark, sf):
    return FE.idf(_vocab(spark, sf), _n_train(spark, sf)).withColumn("idf", F.round("idf", 12))


@register("tfidf", f"""
WITH {_stop_sql()}, {TERMS_SQL.strip()}, {VOCAB_SQL.strip()},
i AS (SELECT term_index, ln(({N_TRAIN_SQL} + 1.0) / (df + 1.0)) AS idf FROM voc)
SELECT dt.doc_id, voc.term_index, dt.term, round(dt.tf * i.idf, 9) AS tfidf
FROM dt JOIN voc ON dt.term = voc.term JOIN i ON i.term_index = voc.term_index
""", ("labelled",))
def q_tfidf(spark, sf):
    terms = FE.doc_terms(_filtered(spark, sf), "doc_id", "tokens")
    out = FE.tfidf(terms, FE.idf(_vocab(spark, sf), _n_train(spark, sf)), "doc_id")
    return out.withColumn("tfidf", F.round("tfidf", 9))


@register("tfidf_smooth_l2", f"""
WITH ct AS (SELECT doc_id, list_filter({CLEAN_SQL}, lambda w: length(w) >= 2) AS t FROM labelled),
dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM ct) u GROUP BY doc_id, term),
st AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
w AS (SELECT dt.doc_id, dt.term,
             dt.tf * (ln((1.0 + (SELECT count(*) FROM ct)) / (1.0 + st.df)) + 1.0) AS w
      FROM dt JOIN st ON dt.term = st.term),
n AS (SELECT doc_id, sqrt(list_reduce(list_sort(list(w * w)), lambda a, b: a + b)) AS norm FROM w GROUP BY doc_id)
SELECT w.doc_id, w.term, round(w.w / n.norm, 12) AS weight FROM w JOIN n ON w.doc_id = n.doc_id
""", ("labelled",))
def q_tfidf_smooth_l2(spark, sf):
    docs = labelled(spark, sf).select(
        "doc_id", F.filter(X.clean_tokens("text"), lambda w: F.length(w) >= 2).alias("tokens"))
    return FE.tfidf_smooth_l2(docs, "doc_id", "tokens").withColumn("weight", F.round("weight", 12))


@register("label_index", """
WITH c AS (SELECT label, count(*) AS count FROM labelled GROUP BY label)
SELECT label, count, CAST(row_number() OVER (ORDER BY count DESC, label ASC) - 1 AS DOUBLE) AS label_index FROM c
""", ("labelled",))
def q_label_index(spark, sf):
    return FE.label_index_table(labelled(spark, sf))
