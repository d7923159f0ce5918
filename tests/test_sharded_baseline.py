"""The baseline whose vocabulary lies on the executors against the one that Spark ML fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from sentiscope.operators import prepare as P
from sentiscope.plans import baseline as B
from sentiscope.plans import model as MD
from sentiscope.plans.lbfgs import Search
from sentiscope.sources.fixtures import labelled


@pytest.fixture(scope="module")
def splits(spark):
    train, val, _ = P.split_frames(labelled(spark, SF_CHECK))
    return train.select("text", "label").persist(), val.select("text", "label").persist()


def _coefficients(model):
    """Per term the coefficients of Spark's model, as it was fitted."""
    cv, lr = model.stages[1], model.stages[-1]
    return dict(zip(cv.vocabulary, lr.coefficientMatrix.toArray().T)), lr.interceptVector.toArray()


def _ours(model):
    found = dict(zip(model.entries.dense, model.dense))
    if model.rare is not None:
        found |= {r["term"]: np.array([r[f"g{c}"] for c in range(model.k)]) for r in model.rare.collect()}
    return found, model.intercept


@pytest.mark.parametrize("classes,dense,steps", [(3, 500, 10), (2, 500, 4), (3, 1 << 17, 4)])
def test_coefficients_are_those_of_spark(splits, classes, dense, steps):
    train, val = splits
    if classes == 2:
        train, val = (f.where("label <> 'neutral'") for f in splits)
    want, ours = MD.fit_smooth_tfidf_baseline(train, max_iter=steps), B.fit_baseline(train, steps, dense_terms=dense)
    assert len(ours.entries.dense) <= dense and (ours.rare is not None) == (dense == 500)
    assert ours.labels == list(want.stages[-2].labels)
    (a, a0), (b, b0) = _ours(ours), _coefficients(want)
    assert a.keys() == b.keys()
    centred = np.array([a[t] for t in b])
    centred = centred - centred.mean(axis=1, keepdims=True) if classes == 3 else centred
    theirs = np.array(list(b.values()))
    assert np.abs(centred - theirs).max() < 1e-5 * np.abs(theirs).max()
    assert np.abs(a0 - (a0.mean() if classes == 3 else 0) - b0).max() < 1e-5 * max(1, np.abs(b0).max())
    got = {tuple(r) for r in ours.transform(val).groupBy("label_index", "prediction").count().collect()}
    assert got == {tuple(r) for r in want.transform(val).groupBy("label_index", "prediction").count().collect()}


def test_odd_rows(spark):
    rows = [("good fine product", "positive"), ("", "positive"), (None, "negative"), ("bad bad thing", "negative"), ("good", "positive"),
            ("bad product", "negative")] * 4
    frame = spark.createDataFrame(rows, "text string, label string").repartition(3)
    model = B.fit_baseline(frame, 5, dense_terms=2)
    scored = model.transform(frame)
    assert scored.count() == len(rows)  # a text that is null or unknown gets the intercepts
    want = MD.fit_smooth_tfidf_baseline(frame, max_iter=5).transform(frame)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, want.select("label_index", "prediction").collect()))
    alone = B.fit_baseline(frame.where("label = 'positive'"), 5)
    assert {r["prediction"] for r in alone.transform(frame.where("label = 'positive'")).collect()} == {0.0}


def test_nothing_of_the_vocabularys_size_is_collected(splits):
    """Of the terms only the dense ones are on the driver; the others are rows."""
    entries = B.fit_baseline(splits[0], 1, dense_terms=300).entries
    assert len(entries.dense) <= 300 and entries.centre.shape == entries.scale.shape == (len(entries.dense),)
    terms = splits[0].select(F.explode(F.expr(MD.clean_tokens_sql()))).distinct().count()
    assert entries.rare_terms.count() == terms - len(entries.dense) > 300


def test_search_over_shares_finds_the_minimum():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(60, 8))
    a, b = a.T @ a / 60 + np.eye(8), rng.normal(size=8)

    class Bowl:
        gradients = []

        def at(self, shares):
            return sum((s * g for s, g in zip(shares, self.gradients)), np.zeros(8))

        def add_gradient(self, point):
            self.gradients.append(a @ self.at(point) - b)
            return np.array([g @ self.gradients[-1] for g in self.gradients])

        def along(self, point, way):
            x = self.at(point)
            return x @ a @ x / 2 - b @ x, (a @ x - b) @ self.at(way)

    bowl = Bowl()
    found = bowl.at(Search(bowl, 30).run())
    assert np.abs(found - np.linalg.solve(a, b)).max() < 1e-4


def test_drawn_rows_are_fitted_as_if_repeated(spark):
    texts = [f"{'good fine' if i % 3 else 'bad'} thing{i % 5} word{i}" for i in range(30)]
    frame = spark.createDataFrame([(t, "abc"[i % 3]) for i, t in enumerate(texts)], "text string, label string").repartition(2)
    counted = B.counted_texts(frame)
    times = {r["row"]: r["row"] % 4 for r in counted.select("row").collect()}  # some rows never
    drawn = spark.createDataFrame([(k,) for k, n in times.items() for _ in range(n)], "row long")
    text_of = {r["row"]: r for r in counted.collect()}
    repeated = spark.createDataFrame([(" ".join(t for t, c in zip(text_of[k]["terms"], text_of[k]["counts"]) for _ in range(c)), text_of[k]["label"])
                                      for k, n in times.items() for _ in range(n)], "text string, label string")
    a, b = B.fit_counted(counted, drawn, 4, dense_terms=2), B.fit_baseline(repeated, 4, dense_terms=2)
    assert a.labels == b.labels and a.rare is not None
    (x, x0), (y, y0) = _ours(a), _ours(b)
    assert x.keys() == y.keys() and max(np.abs(x[t] - y[t]).max() for t in x) < 1e-9 and np.abs(x0 - y0).max() < 1e-9
    assert sorted(map(tuple, a.transform_counted(counted).collect())) == sorted(map(tuple, b.transform(frame).collect()))


def test_a_pass_has_no_more_tasks_than_its_entries_need(spark, splits):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        entries = B.fit_baseline(splits[0].limit(40), 1, dense_terms=300).entries
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert entries.parts == entries.rows.rdd.getNumPartitions() == 1
    cores = spark.sparkContext.defaultParallelism
    assert B._passes(spark, cores * B.FEWEST_ENTRIES) == cores and B._passes(spark, 1000 * cores * B.ENTRIES_PER_TASK) == 1000 * cores


def test_resampled_baselines_count_a_text_once(spark, monkeypatch):
    from sentiscope import catalog

    catalog.load_all()
    from sentiscope.plans import model_queries as MQ

    counted, inner = [], B.counted_texts
    for module in (B, MQ):
        monkeypatch.setattr(module, "counted_texts", lambda frame, *a, **k: counted.append(frame) or inner(frame, *a, **k))
    rows = catalog.QUERIES["resampled_baseline_metrics"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 3 and len(counted) == 2  # the training texts and the validation texts
