"""Shared features of trials, a search that goes on after a stop, tune -> refit -> served model, live table."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from sentiscope.operators import prepare as P
from sentiscope.plans import model as MD
from sentiscope.plans import registry
from sentiscope.plans import search as SR
from sentiscope.plans.shared_features import SharedFeatures
from sentiscope.sources.fixtures import labelled
from sentiscope.sources.store import read_store
from sentiscope.streaming import live, publish, sink, sources
from sentiscope.streaming.parse import parse_messages

SMALL = dict(vocab_size=300, min_df=2, max_iter=4, reg_param=0.001, use_bigrams=True)
SPACE = dict(vocab_size=[200, 300], min_df=[2], max_iter=[3, 4], reg_param=[0.0, 0.001])
FLAT = {k: v for k, v in SPACE.items() if len(v) > 1}


@pytest.fixture(scope="module")
def splits(spark):
    train, val, _ = SR.search_splits(labelled(spark, SF_CHECK))
    return train.persist(), val.persist()


def _fake(train, val, cfg):
    """A score that depends on the configuration alone."""
    value = 0.5 + math.sin(sum(hash(str(v)) % 97 for v in (cfg["vocab_size"], cfg["max_iter"])) + cfg["reg_param"] * 1e4) / 10
    keys = ("accuracy", "macro_f1", *(f"{c}_{m}" for c in ("positive", "negative", "neutral") for m in ("f1", "precision", "recall")))
    return dict.fromkeys(keys, value)


def test_shared_features_are_those_of_the_whole_pipeline(splits):
    train, val = splits
    config = {**SMALL, "vocab_size": 1 << 17, "min_df": 1}  # no cut among equal counts
    shared = SharedFeatures(train, val)
    ours, whole = shared.fit(**config), MD.fit(train, **config)
    a = ours.transform(shared.val).agg(F.count(F.lit(1)), F.sum("prediction")).first()
    b = whole.transform(val).agg(F.count(F.lit(1)), F.sum("prediction")).first()
    assert a[0] == b[0]
    ours_vocab = {t for s in ours.stages if hasattr(s, "vocabulary") for t in s.vocabulary}
    whole_vocab = {t for s in whole.stages if hasattr(s, "vocabulary") for t in s.vocabulary}
    assert ours_vocab == whole_vocab
    # the same terms weigh the same
    idf = {}
    for model in (ours, whole):
        counts = [s for s in model.stages if hasattr(s, "vocabulary")]
        scales = [s.getScalingVec() if hasattr(s, "getScalingVec") else s.idf for s in model.stages
                  if hasattr(s, "getScalingVec") or hasattr(s, "idf")]
        idf[model] = {t: v for c, w in zip(counts, scales) for t, v in zip(c.vocabulary, w.toArray())}
    assert all(abs(idf[ours][t] - v) < 1e-12 for t, v in idf[whole].items())
    f_ours, f_whole = shared.score(config), SR.train_and_score(train, val, config)
    assert f_ours.keys() == f_whole.keys() and abs(f_ours["accuracy"] - f_whole["accuracy"]) < 0.05


def test_a_stopped_search_goes_on_with_the_same_log(spark, splits, tmp_path):
    train, val = splits
    options = dict(steps=8, initial=SR.INITIAL_CONFIG, scorer=_fake, sample_size=77)
    best, metrics, log = SR.simulated_annealing(train, val, log_path=f"{tmp_path}/whole", **options)
    whole = [r.asDict() for r in log.drop("timestamp").orderBy("step").collect()]
    assert len(whole) == 9 and {r["sample_size"] for r in whole} == {77}
    stored = [r.asDict() for r in SR.read_trial_log(spark, f"{tmp_path}/whole").drop("timestamp").orderBy("step").collect()]
    assert stored == whole
    for stop in (1, 4, 9):
        path = f"{tmp_path}/stop-{stop}"

        def stopping(trials, stop=stop):
            if len(trials) == stop:
                raise KeyboardInterrupt

        with pytest.raises(KeyboardInterrupt):
            SR.simulated_annealing(train, val, log_path=path, on_trial=stopping, **options)
        again, again_metrics, rest = SR.simulated_annealing(train, val, log_path=path, **options)
        assert [r.asDict() for r in rest.drop("timestamp").orderBy("step").collect()] == whole
        assert (again, again_metrics) == (best, metrics)


def test_tune_refit_serve_and_stream_without_restart(spark, tmp_path):
    rows = labelled(spark, SF_CHECK)
    base = f"{tmp_path}/models"
    served = registry.tune_and_serve(rows, base, f"{tmp_path}/log", version="one", steps=1, initial=SMALL, space=FLAT)
    assert registry.served_version(spark, base) == "one" and served["config"].keys() == SMALL.keys()
    _, _, test = P.split_frames(rows)
    first, second = test.where("doc_id % 2 = 0"), test.where("doc_id % 2 = 1")
    publish.publish_files(publish.prepare_messages(first), f"{tmp_path}/messages", 1)
    stream = parse_messages(sources.file_messages(spark, f"{tmp_path}/messages"))
    query, _ = sink.start(stream, f"{tmp_path}/store", f"{tmp_path}/ckpt", trigger={"processingTime": "1 second"},
                          scorer=registry.ServedModel(spark, base).score)
    try:
        query.processAllAvailable()
        registry.train_and_save(rows, base, {**SMALL, "max_iter": 2}, version="two", evaluate_test=False)
        assert registry.served_version(spark, base) == "one"  # saved, not served yet
        registry.serve(spark, base, "two")
        publish.publish_files(publish.prepare_messages(second), f"{tmp_path}/messages", 1, mode="append")
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.model_version: r["count"] for r in read_store(spark, f"{tmp_path}/store").groupBy("model_version").count().collect()}
    assert got == {"one": first.count(), "two": second.count()}
    with pytest.raises(FileNotFoundError):
        registry.serve(spark, base, "three")


def test_sample_size_takes_the_first_reviews(spark):
    train, val, test = SR.search_splits(labelled(spark, SF_SMALL), 30)
    ids = [r.doc_id for frame in (train, val, test) for r in frame.select("doc_id").collect()]
    assert sorted(ids) == [r.doc_id for r in labelled(spark, SF_SMALL).orderBy("doc_id").limit(30).collect()]


def test_live_table_upserts_and_survives_a_replay(spark, tmp_path):
    path = f"{tmp_path}/live"
    table = live.LiveTable(path, "score")

    def counts(**rows):
        return spark.createDataFrame([(int(k[1:]), v) for k, v in rows.items()], "score int, count long")

    with pytest.raises(FileNotFoundError):
        live.read_live(spark, path)
    table(counts(s1=2, s5=1), 0)
    table(counts(s5=4), 1)
    table(counts(s5=4), 1)  # replayed
    table(counts(s3=1), 2)
    assert {r["score"]: r["count"] for r in live.read_live(spark, path).collect()} == {1: 2, 3: 1, 5: 4}
    assert len([p for p in (tmp_path / "live").iterdir() if p.name.startswith("v")]) == 2


def test_live_stream_goes_on_after_a_restart(spark, tmp_path):
    rows = labelled(spark, SF_SMALL)
    want = {r["score"]: r["count"] for r in rows.groupBy("score").count().collect()}
    for part, mode in ((0, "overwrite"), (1, "append")):
        publish.publish_files(publish.prepare_messages(rows.where(f"doc_id % 2 = {part}")), f"{tmp_path}/messages", 2, mode=mode)
        counts = live.live_counts(parse_messages(sources.file_messages(spark, f"{tmp_path}/messages")), "score")
        live.start_live_table(counts, f"{tmp_path}/table", f"{tmp_path}/ckpt", refresh=None).awaitTermination()
    assert {r["score"]: r["count"] for r in live.read_live(spark, f"{tmp_path}/table").collect()} == want
