"""The stored counts that the trials of a search share."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sentiscope.operators import features as FE
from sentiscope.operators.evaluate import metrics_record
from sentiscope.plans import search as SR
from sentiscope.plans.shared_features import SharedFeatures
from sentiscope.sources.fixtures import labelled

CONFIG = dict(vocab_size=60, min_df=3, max_iter=4, reg_param=0.001, use_bigrams=True)


@pytest.fixture(scope="module")
def splits(spark):
    train, val, _ = SR.search_splits(labelled(spark, SF_SMALL))
    return train.persist(), val.persist()


def test_trials_of_the_space_read_the_same_counts(splits):
    shared = SharedFeatures(*splits, vocabularies=[(80, 2), (80, 3)])
    first = shared.score(CONFIG)
    counted = dict(shared.counted)
    assert counted.keys() == {"train", "val"} and not {"filtered_words", "bigrams"} & set(counted["train"].columns)
    for change in ({"vocab_size": 80}, {"min_df": 2}, {"use_bigrams": False}, {"max_iter": 2}):
        shared.score({**CONFIG, **change})
        assert shared.counted == counted  # no text is counted again
    assert shared.score(CONFIG) == first
    shared.score({**CONFIG, "vocab_size": 200})
    assert shared.counted != counted and {len(p) >= 200 for p in shared.pools.values()} == {True}
    assert {k: round(v, 9) for k, v in shared.score(CONFIG).items()} == {k: round(v, 9) for k, v in first.items()}


def test_terms_outside_a_trial_have_no_part_in_it(splits):
    alone, pooled = SharedFeatures(*splits), SharedFeatures(*splits, vocabularies=[(400, 1)])
    want, got = alone.fit(**CONFIG), pooled.fit(**CONFIG)
    size = len(alone.pools["filtered_words"])
    assert size == 60 < len(pooled.pools["filtered_words"])
    ours, theirs = (dict(zip(list(s.pools["filtered_words"]), m.stages[-1].coefficientMatrix.toArray().T))
                    for s, m in ((pooled, got), (alone, want)))
    assert all(abs(ours[t] - c).max() < 1e-6 for t, c in theirs.items())
    assert all(not ours[t].any() for t in ours.keys() - theirs.keys())
    for shared, model in ((alone, want), (pooled, got)):
        assert shared.score(CONFIG) == metrics_record(model.transform(shared.val), labels=tuple(shared.labels.labels)).first().asDict()


def test_statistics_of_stored_tokens(spark):
    frame = spark.createDataFrame([(["a", "b", "a"],), ([],), (None,), (["b", None],), (["a"],)], "tokens array<string>")
    want = {tuple(r) for r in FE.term_stats_from_tokens(frame.select(F.filter("tokens", lambda t: t.isNotNull()).alias("tokens")), "tokens").collect()}
    assert {tuple(r) for r in FE.term_stats_from_stored(frame, "tokens").collect()} == want == {("a", 3, 2), ("b", 2, 2)}
