"""Model round trip, stream = batch, restart / replay idempotence, message traps, scans."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sentiscope.operators import prepare as P
from sentiscope.plans import model as MD
from sentiscope.sources import store as ST
from sentiscope.sources.fixtures import labelled, reviews
from sentiscope.streaming import progress, publish, sink, sources
from sentiscope.streaming.parse import parse_messages
from sentiscope.streaming.predict import scored_stream

SMALL = dict(vocab_size=500, min_df=1, max_iter=5, reg_param=0.0001, use_bigrams=True)


@pytest.fixture(scope="module")
def fitted(spark):
    train, _, _ = P.split_frames(labelled(spark, SF_SMALL))
    return MD.fit(P.add_class_weights(train), **SMALL)


def test_model_has_ten_stages_and_label_order(fitted):
    assert len(fitted.stages) == 10
    assert MD.label_order(fitted)[0] == "positive"


def test_model_round_trip(spark, fitted, tmp_dir):
    path = MD.save(fitted, MD.versioned_path(tmp_dir + "/model", "1"))
    again = MD.load(path)
    test = labelled(spark, SF_SMALL)
    a = MD.score(fitted, test, keep=("doc_id",)).select("doc_id", "prediction", "probability")
    b = MD.score(again, test, keep=("doc_id",)).select("doc_id", "prediction", "probability")
    assert a.exceptAll(b).count() == 0


def test_unigram_and_bigram_only_variants(spark):
    train, _, _ = P.split_frames(labelled(spark, SF_SMALL))
    w = P.add_class_weights(train)
    assert len(MD.fit(w, vocab_size=300, min_df=1, max_iter=3).stages) == 6
    assert len(MD.fit(w, vocab_size=300, min_df=1, max_iter=3, bigrams_only=True).stages) == 7
    plain = MD.fit(P.unit_weights(train), vocab_size=300, min_df=1, max_iter=3, weighted=False)
    assert len(plain.stages) == 6


def test_bad_messages(spark, tmp_dir):
    lines = ["not json", json.dumps({"text": None, "score": 5}), json.dumps({"text": "x"}),
             json.dumps({"text": "x", "score": "5"}), json.dumps({"text": "x", "score": 4.5}),
             json.dumps({"text": "ok", "score": 4, "extra": 1})]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = sorted((r["text"], r["score"]) for r in parse_messages(df).collect())
    assert got == [("ok", 4), ("x", None), ("x", None), ("x", None)]


def test_stream_equals_batch_and_replay_is_idempotent(spark, fitted, tmp_dir):
    _, _, test = P.split_frames(labelled(spark, SF_SMALL))
    msgs = publish.prepare_messages(test)
    publish.publish_files(msgs, f"{tmp_dir}/messages", 3)
    stream = scored_stream(sources.file_messages(spark, f"{tmp_dir}/messages"), fitted)
    query, snk = sink.start(stream, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")
    query.awaitTermination()
    store = ST.read_store(spark, f"{tmp_dir}/store")
    batch = MD.score(fitted, parse_messages(msgs))
    cols = ["text", "score", "prediction", "predicted_label", "probability"]
    assert store.count() == msgs.count()
    assert store.select(cols).exceptAll(batch.select(cols)).count() == 0
    told = progress.batch_progress(spark, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", snk.run_id).collect()
    stored = {r["batch_id"]: r["count"] for r in store.groupBy("batch_id").count().collect()}
    assert {r["batch_id"]: r["rows"] for r in told if r["rows"]} == stored
    assert all(r["finished_at"] is not None and r["seconds"] >= 0 and "logOffset" in r["offset"] for r in told)
    lag = progress.file_lag(spark, f"{tmp_dir}/messages", f"{tmp_dir}/ckpt").first()
    assert (lag["files"], lag["taken"], lag["waiting"]) == (3, 3, 0)
    # a restart with the same checkpoint and no new files writes nothing new
    q2, _ = sink.start(stream, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")
    q2.awaitTermination()
    assert ST.read_store(spark, f"{tmp_dir}/store").count() == msgs.count()
    # replaying a batch rewrites its partition instead of appending
    first = ST.read_store(spark, f"{tmp_dir}/store").where("batch_id = 0").drop("batch_id", "processed_at", "source")
    n0 = first.count()
    snk(spark.createDataFrame(first.collect(), first.schema), 0)
    assert ST.read_store(spark, f"{tmp_dir}/store").where("batch_id = 0").count() == n0


def test_store_insert_find_and_purge(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    doc = spark.createDataFrame([(7, "preview", 5, 0.0, "positive", [0.9, 0.05, 0.05], "python_test")],
                                "event_id long, text_preview string, score int, prediction double, "
                                "predicted_label string, probability array<double>, source string")
    ST.insert_documents(doc.withColumn("processed_at", F.current_timestamp()), path)
    got = ST.find_by_id(spark, path, 7).collect()
    assert len(got) == 1 and got[0]["text"] is None and got[0]["batch_id"] is None
    assert ST.purge_source(spark, path, "python_test")
    assert ST.read_store(spark, path).count() == 0


def test_csv_scans(spark, tmp_dir):
    from sentiscope.sources import files

    raw = reviews(spark, SF_SMALL)
    raw.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(
        f"{tmp_dir}/reviews")
    strict = files.ingest_strict(spark, f"{tmp_dir}/reviews", f"{tmp_dir}/reviews_parquet")
    assert strict.count() == raw.count()
    assert strict.where(F.col("_corrupt_record").isNotNull()).count() == 0
    clean = P.clean_reviews(strict)
    assert clean.count() == P.clean_reviews(raw).count()
    labelled_rows = files.scan_reviews(spark, f"{tmp_dir}/reviews")
    assert labelled_rows.columns == ["Text", "Score"]


def test_jsonl_export_and_scan(spark, tmp_dir):
    from sentiscope.sources import files

    _, _, test = P.split_frames(labelled(spark, SF_SMALL))
    files.export_jsonl(test, f"{tmp_dir}/test_jsonl")
    back = files.scan_jsonl(spark, f"{tmp_dir}/test_jsonl")
    assert back.count() == test.count()
    assert set(back.columns) == {"text", "score", "label"}
    assert os.path.isdir(f"{tmp_dir}/test_jsonl")


def test_train_and_save_job(spark, tmp_dir):
    from sentiscope.plans.train import train_and_save

    model, path, metrics = train_and_save(labelled(spark, SF_SMALL), tmp_dir + "/models", SMALL, version="t1")
    assert path.endswith("/v=t1") and os.path.isdir(path)
    for split in ("val", "test"):
        m = metrics[split]
        assert 0.0 <= m["accuracy"] <= 1.0 and 0.0 <= m["macro_f1"] <= 1.0
        assert set(m) >= {"positive_f1", "negative_f1", "neutral_f1"}


def test_report_tables_and_trial_log_writer(spark, tmp_dir):
    from sentiscope.operators import monitor as M
    from sentiscope.plans import report, search
    from sentiscope.sources.fixtures import predictions

    store = predictions(spark, SF_SMALL)
    tables = report.report_tables(M.analytics_scan(store), M.latest_predictions(store))
    report.write_report(tables, tmp_dir + "/report")
    back = spark.read.option("header", True).csv(tmp_dir + "/report/low_confidence_samples")
    assert back.columns == ["processed_at", "score", "predicted_label", "confidence", "batch_id"]
    assert 0 < back.count() <= 20
    log = spark.createDataFrame([(0, 0.5)], "step int, macro_f1 double")
    search.write_trial_log(log, tmp_dir + "/trials")
    assert spark.read.option("header", True).csv(tmp_dir + "/trials").count() == 1


def test_console_and_live_counts(spark, fitted, tmp_dir):
    from sentiscope.streaming import live

    _, _, test = P.split_frames(labelled(spark, SF_SMALL))
    publish.publish_files(publish.prepare_messages(test), f"{tmp_dir}/messages", 2)
    stream = scored_stream(sources.file_messages(spark, f"{tmp_dir}/messages"), fitted)
    q = live.start_console(stream, f"{tmp_dir}/ckpt-console")
    q.awaitTermination()
    lq = live.start_live_counts(stream, f"{tmp_dir}/ckpt-live", query_name="live_test", refresh=None)
    lq.awaitTermination()
    counts = {r["sentiment"]: r["count"] for r in spark.table("live_test").collect()}
    assert sum(counts.values()) == test.count()


def test_compact_batches_keeps_rows_and_reduces_files(spark, tmp_dir):
    import glob

    path = f"{tmp_dir}/store"
    from sentiscope.sources.fixtures import predictions

    store = predictions(spark, SF_SMALL).where("batch_id <= 3")
    ST.write_partitions(store.repartition(8), path)
    before = ST.read_store(spark, path).select("event_id", "batch_id", "predicted_label")
    want = sorted(map(tuple, before.collect()))
    n_before = len(glob.glob(f"{path}/source=spark_structured_streaming/run_id=*/batch_id=*/*.parquet"))
    assert ST.compact_batches(spark, path, "spark_structured_streaming", 3) == len(want)
    after = ST.read_store(spark, path).select("event_id", "batch_id", "predicted_label")
    assert sorted(map(tuple, after.collect())) == want
    n_after = len(glob.glob(f"{path}/source=spark_structured_streaming/run_id=*/batch_id=*/*.parquet"))
    assert n_after < n_before


def test_cleaned_stream_equals_batch_clean(spark, tmp_dir):
    from sentiscope.functions.text import clean_text
    from sentiscope.streaming.predict import cleaned_stream

    _, _, test = P.split_frames(labelled(spark, SF_SMALL))
    msgs = publish.prepare_messages(test)
    publish.publish_files(msgs, f"{tmp_dir}/messages", 2)
    q = (cleaned_stream(sources.file_messages(spark, f"{tmp_dir}/messages")).writeStream
         .format("memory").queryName("cleaned_test").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("cleaned_test")
    want = parse_messages(msgs).select(clean_text("text").alias("clean_text"), "score")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_cli_train_publish_stream_report(spark, tmp_dir, monkeypatch):
    import glob

    from sentiscope import cli
    from sentiscope.plans import model as model_mod

    monkeypatch.setattr(model_mod, "FINAL_CONFIG", SMALL)
    cli.main(["train", "--data", SF_SMALL, "--models", f"{tmp_dir}/models", "--version", "c1", "--serve"])
    cli.main(["export", "--data", SF_SMALL, "--out", f"{tmp_dir}/export"])
    cli.main(["publish", "--exported", f"{tmp_dir}/export", "--out", f"{tmp_dir}/msgs", "--rows-per-file", "5"])
    cli.main(["stream", "--models", f"{tmp_dir}/models", "--messages", f"{tmp_dir}/msgs",
              "--store", f"{tmp_dir}/store", "--checkpoint", f"{tmp_dir}/ckpt", "--once"])
    cli.main(["progress", "--store", f"{tmp_dir}/store", "--checkpoint", f"{tmp_dir}/ckpt", "--messages", f"{tmp_dir}/msgs"])
    cli.main(["compact", "--store", f"{tmp_dir}/store", "--source", "spark_structured_streaming", "--up-to-batch", "0"])
    cli.main(["report", "--store", f"{tmp_dir}/store", "--out", f"{tmp_dir}/report"])
    _, _, test = P.split_frames(labelled(spark, SF_SMALL))
    assert ST.read_store(spark, f"{tmp_dir}/store").where("model_version = 'c1'").count() == test.count()
    assert ST.read_store(spark, f"{tmp_dir}/store").count() > 0
    assert glob.glob(f"{tmp_dir}/report/summary/*.csv")


def test_smooth_tfidf_baseline_matches_relational_twin(spark):
    from sentiscope.functions.text import clean_tokens
    from sentiscope.operators.features import tfidf_smooth_l2

    lab = labelled(spark, SF_SMALL)
    model = MD.fit_smooth_tfidf_baseline(lab, max_iter=3)
    tokens_stage, cv = model.stages[0], model.stages[1]
    # the SQL token stage equals the column expression
    a = tokens_stage.transform(lab).select("doc_id", "clean_tokens")
    b = lab.select("doc_id", F.filter(clean_tokens("text"), lambda w: F.length(w) >= 2).alias("clean_tokens"))
    assert a.exceptAll(b).count() == 0
    # feature vectors equal the relational smooth-IDF / L2 weights
    vocab = cv.vocabulary
    feats = model.transform(lab).select("doc_id", "features").collect()
    got = {(r["doc_id"], vocab[i]): v for r in feats for i, v in zip(r["features"].indices, r["features"].values)}
    want = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf_smooth_l2(b, "doc_id", "clean_tokens").collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert model.transform(lab).select("prediction").count() == lab.count()


def test_restart_processes_only_new_messages(spark, fitted, tmp_dir):
    lab = labelled(spark, SF_SMALL)
    first = publish.prepare_messages(lab.where("doc_id < 100"))
    second = publish.prepare_messages(lab.where("doc_id >= 100"))
    publish.publish_files(first, f"{tmp_dir}/messages", 2)
    stream = scored_stream(sources.file_messages(spark, f"{tmp_dir}/messages"), fitted)
    q1, s1 = sink.start(stream, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")
    q1.awaitTermination()
    n1 = ST.read_store(spark, f"{tmp_dir}/store").count()
    assert n1 == first.count()
    told = progress.batch_progress(spark, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", s1.run_id).collect()
    last_batch = max(p["batch_id"] for p in told)
    publish.publish_files(second, f"{tmp_dir}/messages", 2, mode="append")
    assert progress.file_lag(spark, f"{tmp_dir}/messages", f"{tmp_dir}/ckpt").first()["waiting"] == 2
    q2, s2 = sink.start(stream, f"{tmp_dir}/store", f"{tmp_dir}/ckpt")
    q2.awaitTermination()
    store = ST.read_store(spark, f"{tmp_dir}/store")
    assert store.count() == first.count() + second.count()
    assert s2.run_id == s1.run_id
    told = progress.batch_progress(spark, f"{tmp_dir}/store", f"{tmp_dir}/ckpt", s2.run_id)
    assert told.where(f"batch_id > {last_batch}").agg(F.sum("rows")).first()[0] == second.count()
    assert store.where(f"batch_id > {last_batch}").count() == second.count()


def test_cli_trains_and_tunes_from_a_csv(spark, tmp_dir, monkeypatch):
    from sentiscope import cli
    from sentiscope.plans import model as model_mod
    from sentiscope.plans import search

    raw = reviews(spark, SF_SMALL).select("Text", "Score").withColumn("Text", F.translate("Text", "\n\r", "  "))
    raw.coalesce(1).write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{tmp_dir}/csv")
    monkeypatch.setattr(model_mod, "FINAL_CONFIG", SMALL)
    monkeypatch.setattr(search, "INITIAL_CONFIG", {**SMALL, "vocab_size": 10000, "min_df": 3, "max_iter": 15, "reg_param": 0.0001})
    cli.main(["train", "--csv", f"{tmp_dir}/csv", "--models", f"{tmp_dir}/models", "--version", "c1"])
    cli.main(["tune", "--csv", f"{tmp_dir}/csv", "--out", f"{tmp_dir}/tuning", "--steps", "0"])
    cli.main(["tune", "--csv", f"{tmp_dir}/csv", "--out", f"{tmp_dir}/tuning", "--steps", "1", "--models", f"{tmp_dir}/models", "--version", "c2"])
    log = search.read_trial_log(spark, f"{tmp_dir}/tuning/log")
    assert sorted(r.step for r in log.collect()) == [0, 1]
    assert os.path.isdir(f"{tmp_dir}/models/v=c2") and open(f"{tmp_dir}/models/_current").read() == "c2"
