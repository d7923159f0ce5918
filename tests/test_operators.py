"""Semantics traps and scale helpers."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from sentiscope.functions import text as X
from sentiscope.operators import monitor as M
from sentiscope.operators import prepare as P
from sentiscope.operators import ranking as R
from sentiscope.operators import stats as ST
from sentiscope.sources.fixtures import labelled


def test_histogram_edges_right_closed_lowest_included(spark):
    vals = [0.0, 0.5, 0.5000001, 0.6, 0.9, 0.95, 1.0, -0.1, 1.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "confidence double")
    got = {r["bin"]: r["count"] for r in M.confidence_histogram(df).collect()}
    assert got == {0: 2, 1: 2, 2: 0, 3: 0, 4: 1, 5: 2}


def test_clean_text_semantics(spark):
    df = spark.createDataFrame([("I'm NOT happy, good,bad!! don't",), (None,)], "t string")
    got = [r[0] for r in df.select(X.clean_text("t")).collect()]
    assert got == ["happy goodbad dont", ""]


def test_bigrams_short_inputs(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "t array<string>")
    got = [r[0] for r in df.select(X.bigrams("t")).collect()]
    assert got == [[], [], ["a b", "b c"]]


def test_tokenizer_twin_equals_spark_ml(spark):
    from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover

    lab = labelled(spark, SF_SMALL).select("doc_id", "text")
    ml = RegexTokenizer(inputCol="text", outputCol="w", pattern="\\W+").transform(lab)
    ml = StopWordsRemover(inputCol="w", outputCol="f").transform(ml)
    ml = NGram(n=2, inputCol="f", outputCol="b").transform(ml)
    twin = ml.select("doc_id", "w", "f", "b",
                     X.tokenize("text").alias("w2"),
                     X.remove_stopwords(X.tokenize("text")).alias("f2"),
                     X.bigrams(X.remove_stopwords(X.tokenize("text"))).alias("b2"))
    bad = twin.where((F.col("w") != F.col("w2")) | (F.col("f") != F.col("f2")) | (F.col("b") != F.col("b2")))
    assert bad.count() == 0


def test_split_is_disjoint_and_partition_independent(spark):
    lab = labelled(spark, SF_CHECK)
    a = P.split_random(lab).select("doc_id", "split")
    b = P.split_random(lab.repartition(7)).select("doc_id", "split")
    assert a.exceptAll(b).count() == 0
    assert a.groupBy("doc_id").count().where("count > 1").count() == 0


def test_group_rank_equals_window_row_number(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("aab"), rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, u double")
    got = R.group_rank(df, "g", "u", "id", out="r", rows_per_task=100)
    want = df.withColumn("r", (F.row_number().over(Window.partitionBy("g").orderBy("u", "id")) - 1).cast("bigint"))
    assert got.select("id", "r").exceptAll(want.select("id", "r")).count() == 0
    assert got.count() == 3000


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 5001])
def test_exact_median(spark, n, monkeypatch):
    monkeypatch.setattr(ST, "DIGIT", 4)               # few bins: values share places
    rng = np.random.default_rng(n)
    vals = np.round(rng.random(n), 3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    assert ST.exact_median(df, "v") == pytest.approx(float(np.median(vals)))


def test_undersample_and_oversample_counts(spark):
    from sentiscope.operators import sampling as S

    rows = [(i, "big") for i in range(300)] + [(1000 + i, "mid") for i in range(60)] + \
           [(2000 + i, "small") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    under = {r["label"]: r["count"] for r in S.undersample(df).groupBy("label").count().collect()}
    assert under == {"big": 155, "mid": 35, "small": 10}
    over = S.oversample(df)
    counts = {r["label"]: r["count"] for r in over.groupBy("label").count().collect()}
    assert counts == {"big": 300, "mid": 300, "small": 300}
    assert over.where("is_original").count() == 370
    # drawn rows come from their own class
    assert over.join(df.withColumnRenamed("label", "l0"), "doc_id").where("label <> l0").count() == 0
    # deterministic
    assert over.exceptAll(S.oversample(df.repartition(5))).count() == 0


def test_suspicious_rule(spark):
    rows = [(5, "negative"), (1, "positive"), (4, "neutral"), (5, "neutral"), (3, "neutral"), (2, "positive")]
    df = spark.createDataFrame(rows, "score int, predicted_label string")
    assert M.suspicious(df).count() == 4


def test_lemma_table_rules(spark):
    from sentiscope.operators.features import noun_lemma_table

    lex = spark.createDataFrame([(w,) for w in
                                 ["dogs", "dog", "boxes", "box", "berries", "berry", "men", "man", "glass"]],
                                "term string")
    got = {r["term"]: r["lemma"] for r in noun_lemma_table(lex).collect()}
    assert got["dogs"] == "dog" and got["boxes"] == "box" and got["berries"] == "berry"
    assert "glass" not in got and "dog" not in got  # a word that is its own lemma needs no row


def _bin_reference(v):
    """Right-closed bins over (0, .5, .6, .7, .8, .9, 1.0] with the lowest edge included."""
    if v is None or v < 0.0 or v > 1.0:
        return None
    for i, hi in enumerate((0.5, 0.6, 0.7, 0.8, 0.9, 1.0)):
        if v <= hi:
            return i
    return None


def test_confidence_bin_matches_reference_rule(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.floats(min_value=-0.5, max_value=1.5, allow_nan=False),
                              st.sampled_from([0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])), min_size=1, max_size=60))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double")
        got = {r["i"]: r["b"] for r in df.select("i", M.confidence_bin(F.col("c")).alias("b")).collect()}
        assert got == {i: _bin_reference(v) for i, v in enumerate(values)}

    check()


def test_latest_predictions_two_phase_handles_timestamp_ties(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=i // 7), "spark_structured_streaming", "positive", 5,
             [0.7, 0.2, 0.1], i // 10, "t", "t") for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, processed_at timestamp, source string, "
                                     "predicted_label string, score int, probability array<double>, "
                                     "batch_id long, text string, text_preview string").withColumn(
        "prediction", F.lit(0.0))
    for limit in (1, 5, 7, 13, 200, 500):
        got = [r["event_id"] for r in M.latest_predictions(df, limit=limit).collect()]
        want = [r["event_id"] for r in df.orderBy(F.col("processed_at").desc(), F.col("event_id").desc())
                .limit(limit).collect()]
        assert got == want


def test_confidence_stats_approx_close_to_exact(spark):
    rng = np.random.default_rng(5)
    vals = np.round(rng.random(20_000), 4)
    df = spark.createDataFrame([(float(v),) for v in vals], "confidence double")
    approx = M.confidence_stats_approx(df).first()
    exact = M.confidence_stats(df).first()
    assert approx["min_confidence"] == exact["min_confidence"]
    assert approx["max_confidence"] == exact["max_confidence"]
    assert abs(approx["median_confidence"] - exact["median_confidence"]) <= 0.1   # percent points
    assert approx["low_confidence_count"] == exact["low_confidence_count"]


def test_spread_and_cluster_conf(spark):
    from sentiscope.session import cluster_conf, spread

    small = spark.range(10).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, numPartitions=4 * spark.sparkContext.defaultParallelism)
    assert spread(wide) is wide                       # large inputs are never reshuffled
    conf = cluster_conf(100 * 2 ** 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 * 2 ** 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10, 8000)["spark.sql.shuffle.partitions"]) == 16000


def _morphy(word, lexicon, exceptions):
    """The noun lemmatiser's search in plain Python: exceptions, else detachment level by level."""
    from sentiscope.operators.features import NOUN_RULES

    def known(forms):
        return [f for f in forms if f in lexicon]

    def detach(forms):
        return [f[:len(f) - len(s)] + r for f in forms for s, r in NOUN_RULES if f.endswith(s)]

    if word in exceptions:
        found = known([word, *exceptions[word]])
    else:
        forms = detach([word])
        found = known([word, *forms])
        while not found and forms:
            forms = detach(forms)
            found = known(forms)
    return min(found, key=len) if found else word


def test_lemmas_with_lexicon_and_exceptions(spark, tmp_path):
    from sentiscope.operators import features as FE
    from sentiscope.sources.lexicon import read_exceptions, read_lexicon

    lexicon = "foot dog box berry man glas glass bus buse church axis ax axe datum s as ass".split()
    exceptions = {"feet": ["foot"], "axes": ["ax", "axis", "axe"], "data": ["datum"], "dice": ["die"]}
    (tmp_path / "index.noun").write_text("  1 licence line  \n" + "".join(f"{w} n 1 0 1 0 0001  \n" for w in lexicon))
    (tmp_path / "noun.exc").write_text("".join(f"{f} {' '.join(ls)}\n" for f, ls in exceptions.items()))
    words = [*lexicon, *exceptions, "feets", "dogs", "dogses", "boxes", "berries", "men", "mens", "glasses", "buses", "churches",
             "sssss", "asses", "assesses", "unknowns", "women", "ies", "men", "z", ""]
    table = FE.noun_lemma_table(spark.createDataFrame([(w,) for w in words] + [(None,)], "term string"),
                                read_lexicon(spark, str(tmp_path)), read_exceptions(spark, str(tmp_path)))
    got = {r.term: r.lemma for r in table.collect()}
    want = {w: _morphy(w, set(lexicon), exceptions) for w in words}
    assert got == {w: v for w, v in want.items() if v != w}
    assert got["feet"] == "foot" and got["mens"] == "man" and got["axes"] == "ax"
    docs = spark.createDataFrame([(1, ["feet", "good", "dogs", "feet"]), (2, ["good"]), (3, []), (4, None)], "doc_id int, tokens array<string>")
    texts = {r.doc_id: r.clean_text for r in FE.lemmatized_texts(docs, "doc_id", "tokens", table).collect()}
    assert texts[1] == "foot good dog foot" and texts[2] == "good" and texts[3] == ""
    rows = FE.lemmatize_tokens(docs, "doc_id", "tokens", table).collect()
    assert sorted((r.doc_id, r.pos, r.token, r.lemma) for r in rows) == [
        (1, 0, "feet", "foot"), (1, 1, "good", "good"), (1, 2, "dogs", "dog"), (1, 3, "feet", "foot"), (2, 0, "good", "good")]


def test_clean_text_splits_at_every_python_space(spark):
    import re

    from sentiscope.functions.text import CLEAN_STOPWORDS, WS, clean_text

    texts = [f"Good{c}day,x{c}" for c in map(chr, range(0x3001)) if c.isspace()] + ["it's​zero width", "tab\x1fsep", None, ""]
    want = [" ".join(w for w in re.sub(r"[^a-z\s]", "", (t or "").lower()).split() if w not in CLEAN_STOPWORDS) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert [r.c for r in df.select("i", clean_text("text").alias("c")).orderBy("i").collect()] == want
    assert set(WS) == {c for c in map(chr, range(0x110000)) if c.isspace() and not 0xD800 <= ord(c) < 0xE000}


def test_exact_median_shapes(spark):
    import random
    import statistics

    rng = random.Random(3)
    for vals in ([1.0], [1.0, 2.0], [0.1] * 5 + [5.0] * 5, [rng.random() for _ in range(1001)], [7.0] * 9 + [1e300],
                 [float(rng.randint(-3, 3)) for _ in range(500)], [1e308, -1e308, 5e-324, 0.3]):
        df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "v double").repartition(4)
        assert ST.exact_median(df, "v") == statistics.median(vals)
    assert ST.exact_median(spark.createDataFrame([], "v double"), "v") is None


def test_crosstab_counts_labels_that_it_does_not_name(spark):
    df = spark.createDataFrame([(1, "positive"), (1, "mixed"), (1, "spam"), (2, "unknown"), (None, "positive")],
                               "score int, predicted_label string")
    rows = {r.score: r for r in M.score_sentiment_crosstab(df).collect()}
    assert rows[1].positive == 1 and rows[1].other == 2 and rows[2].unknown == 1 and len(rows) == 2
