"""Whole-table term statistics, streams whose cost per batch does not grow, rollups of one file per batch."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sentiscope.operators import prepare as P
from sentiscope.plans import model as MD
from sentiscope.sources import rollups as RS
from sentiscope.sources import store as ST
from sentiscope.streaming import live, sink, sources
from sentiscope.streaming.parse import parse_messages


@pytest.fixture()
def corpus(spark, tmp_path):
    """Forty reviews: each has a word of its own, and every two neighbours share a pair of words."""
    rows = [(i, f"own{i} left{i // 2} right{i // 2}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/sf/documents.parquet")
    spark.createDataFrame([(i, 1.0, 0) for i in range(40)], "doc_id long, quality double, toxic int").write.parquet(f"{tmp_path}/sf/labels.parquet")
    return f"{tmp_path}/sf"


USABLE = [i for i in range(40) if i % 17]  # the scores of the others are no numbers


def test_term_stats_count_every_review(spark, corpus):
    got = {r["term"]: (r["tf"], r["df"]) for r in E.queries()["term_stats"](spark, corpus).collect()}
    shared = {f"{side}{i // 2}": (sum(j // 2 == i // 2 for j in USABLE),) * 2 for i in USABLE for side in ("left", "right")}
    assert got == {f"own{i}": (1, 1) for i in USABLE} | shared


def test_bigram_vocabulary_counts_every_review(spark, corpus):
    got = {r["term"]: r["df"] for r in E.queries()["bigram_vocabulary"](spark, corpus).collect()}
    pairs = {i // 2 for i in USABLE if sum(j // 2 == i // 2 for j in USABLE) == 2}
    assert got == {f"left{k} right{k}": 2 for k in pairs}


def _messages(spark, path, files):
    for i in range(files):
        spark.createDataFrame([('{"text": "t", "score": %d}' % (1 + i % 5),)], "value string").coalesce(1).write.mode("append").text(path)


def test_live_state_has_few_partitions_whatever_the_session_shuffles_with(spark, tmp_path):
    _messages(spark, f"{tmp_path}/messages", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        counts = live.live_counts(parse_messages(sources.file_messages(spark, f"{tmp_path}/messages")), "score")
        live.start_live_table(counts, f"{tmp_path}/table", f"{tmp_path}/ckpt", refresh=None).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    state = [n for n in os.listdir(f"{tmp_path}/ckpt/state/0") if n.isdigit()]
    assert len(state) == live.STATE_PARTITIONS
    assert sorted(map(tuple, live.read_live(spark, f"{tmp_path}/table").collect())) == [(1, 1), (2, 1)]


def test_live_table_computes_a_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        seen.add(1)
        return n

    table = live.LiveTable(f"{tmp_path}/live", "score")
    for batch_id, rows in enumerate([[(1, 2), (3, 1)], [(3, 4), (5, 1)]]):
        table(spark.createDataFrame(rows, "score int, count long").withColumn("count", counted("count")), batch_id)
    assert sorted(map(tuple, live.read_live(spark, f"{tmp_path}/live").collect())) == [(1, 2), (3, 4), (5, 1)]
    assert seen.value == 4


def _rows(spark, batches, run="a"):
    return spark.range(batches * 20).select(
        F.col("id").alias("event_id"), (F.col("id") % 5 + 1).cast("int").alias("score"), F.lit("positive").alias("predicted_label"),
        F.array(F.lit(0.5) + F.col("id") % 7 / 20).alias("probability"), F.lit("s").alias("source"), F.lit(run).alias("run_id"),
        F.floor(F.col("id") / 20).alias("batch_id"))


def test_a_batch_has_one_file_of_rollups(spark, tmp_path):
    path = f"{tmp_path}/store"
    ST.write_partitions(_rows(spark, 6), path)
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        RS.refresh_rollups(spark, path, F.lit(True))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)
    for table in ("cells", "values"):
        folders = glob.glob(f"{path}/_rollups/{table}/source=s/run_id=a/batch_id=*")
        assert len(folders) == 6
        assert all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders)


def test_the_sink_reads_back_its_own_batch_only(spark, tmp_path):
    path = f"{tmp_path}/store"
    mine = sink.PredictionSink(path, "s", "a")
    frame = _rows(spark, 1)
    mine(frame, 0)
    for f in glob.glob(f"{path}/source=s/run_id=a/batch_id=0/*.parquet"):  # an unreadable older batch does not stop the next
        with open(f, "wb") as out:
            out.write(b"broken")
    mine(frame, 1)
    cells, _ = RS.read_rollups(spark, path, "s")
    assert {r["batch_id"]: r["n"] for r in cells.groupBy("batch_id").agg(F.sum("n").alias("n")).collect()} == {0: 20, 1: 20}
    read = ST.store(spark, path).one_batch("s", "a", 1).inputFiles()
    assert read and all("batch_id=1/" in f for f in read)
    assert ST.store(spark, path).one_batch("s", "a", 9).count() == 0


@pytest.mark.parametrize("n", [1, 3, 5, 6, 100])
def test_sample_head_has_the_first_rows_also_with_null_and_equal_keys(spark, n):
    keys = [None, None, 1, 1, 1, 2, 5, 9]
    frame = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(keys)], "doc_id long, text string").repartition(4)
    got = P.sample_head(frame, n).collect()
    assert [r["doc_id"] for r in got] == keys[:n]
    assert len({r["text"] for r in got}) == len(got)


def test_sample_head_orders_no_texts_of_all_tasks(spark):
    frame = spark.range(4000, numPartitions=8).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"))
    plan = P.sample_head(frame, 50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "(id#" in plan and "< 49" in plan


def test_a_fit_keeps_the_filtered_words_only(spark, monkeypatch):
    kept = []
    train = spark.createDataFrame([("good nice day", "positive", 1.0), ("bad sad day", "negative", 1.0)] * 4,
                                  "text string, label string, class_weight double")
    persist = type(train).persist
    monkeypatch.setattr(type(train), "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    model = MD.fit(train, vocab_size=20, min_df=1, max_iter=2, use_bigrams=True)
    assert sorted(kept[0]) == ["class_weight", "filtered_words", "label"]
    assert len(model.stages) == 10 and model.transform(train).where("prediction is null").count() == 0
