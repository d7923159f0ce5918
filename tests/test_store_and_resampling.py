"""Latest-N on a sink-written store, stream runs that share a store, null classes, plans without jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sentiscope.operators import monitor as M
from sentiscope.operators import prepare as P
from sentiscope.operators import sampling as S
from sentiscope.sources import store as ST
from sentiscope.sources.fixtures import STREAM_SOURCE, labelled
from sentiscope.streaming import sink

SCORED = "text string, text_preview string, score int, prediction double, predicted_label string, probability array<double>"


def _batch(spark, *texts):
    return spark.createDataFrame([(t, t, 5, 0.0, "negative", [0.9, 0.1, 0.0]) for t in texts], SCORED)


def test_runs_share_a_store_and_a_replay_replaces(spark, tmp_path):
    path = f"{tmp_path}/store"
    first, second = (sink.run_id_of(spark, f"{tmp_path}/ckpt-{i}") for i in (1, 2))
    assert first != second and first == sink.run_id_of(spark, f"{tmp_path}/ckpt-1")
    one, two = sink.PredictionSink(path, run_id=first), sink.PredictionSink(path, run_id=second)
    one(_batch(spark, "a", "b"), 0)
    two(_batch(spark, "c"), 0)
    one(_batch(spark, "a", "b"), 0)  # a replayed batch
    store = ST.read_store(spark, path)
    assert sorted(r.text for r in store.collect()) == ["a", "b", "c"]
    assert store.select("event_id").distinct().count() == 3
    frame = M.latest_predictions(store)
    assert frame.count() == 3 and M.latest_predictions(store, limit=2).count() == 2
    assert M.suspicious(frame).count() == 3


def test_latest_keeps_rows_without_a_time(spark):
    now = dt.datetime(2024, 1, 1)
    rows = [(1, now), (None, now), (2, None), (None, None), (None, None)]
    store = ST.conform(spark.createDataFrame(rows, "event_id long, processed_at timestamp").withColumn("source", F.lit(STREAM_SOURCE)))
    assert M.latest_predictions(store).count() == 5
    assert M.latest_predictions(store, limit=2).where("processed_at is not null").count() == 2


def test_null_class_is_a_class(spark):
    rows = [(i, "a" if i < 12 else "b" if i < 17 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    under = {r["label"]: r["count"] for r in S.undersample(df).groupBy("label").count().collect()}
    assert under == {"a": 7, "b": 4, None: 3}
    over = {r["label"]: r["count"] for r in S.oversample(df).groupBy("label").count().collect()}
    assert over == {"a": 12, "b": 12, None: 12}
    split = P.split_stratified(df) if hasattr(P, "split_stratified") else None
    assert split is None or split.count() == 20
    empty = df.where("doc_id < 0")
    assert S.undersample(empty).count() == 0 and S.oversample(empty).count() == 0


def test_plans_start_no_job(spark):
    def started():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("plans"))

    from sentiscope.sources.tables import table

    sf = "/root/testdata/sf0.001"
    table(spark, sf, "documents"), table(spark, sf, "labels")
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        schemas = started()
        table(spark, sf, "documents"), table(spark, sf, "labels")
        schemas = started() - schemas  # reading two footers
        before = started()
        S.oversample(S.undersample(labelled(spark, sf)))
        assert started() - before <= schemas
    finally:
        spark.sparkContext.setJobGroup("", "")
