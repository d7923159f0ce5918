"""Command line: the jobs a user of the original scripts runs.

  python -m sentiscope.cli train   (--csv CSV | --data SF_DIR) --models DIR [--version V] [--sample-size N] [--resample HOW] [--serve]
  python -m sentiscope.cli tune    (--csv CSV | --data SF_DIR) --out DIR [--steps 8] [--sample-size N] [--models DIR]
  python -m sentiscope.cli export  (--csv CSV | --data SF_DIR) --out DIR
  python -m sentiscope.cli publish --exported DIR (--out DIR | --kafka SERVERS) [--rows-per-file N] [--start-row K]
  python -m sentiscope.cli stream  (--models DIR | --model PATH) --messages DIR --store DIR --checkpoint DIR [--once]
  python -m sentiscope.cli progress --store DIR --checkpoint DIR [--messages DIR]
  python -m sentiscope.cli compact --store DIR --source S --up-to-batch N
  python -m sentiscope.cli report  --store DIR --out DIR [--sentiment S] [--score N] [--batch B] [--limit N]

``--csv`` is a review CSV with a header (``Text``, ``Score``); ``--data`` a folder of the driver tables, from which review
rows are derived (``sources.fixtures.labelled``).  ``tune`` writes each trial before the next begins and, called again
with the same ``--out``, goes on behind the last one; with ``--models`` it refits the best configuration and serves it.
``stream --models`` scores every batch by the version served at that time.  The session comes from ``session.get_spark``
unless one is already active (cluster submit).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _spark():
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from sentiscope.session import get_spark

    return get_spark()


def _labelled(a):
    if a.csv:
        from sentiscope.sources.files import labelled_reviews

        return labelled_reviews(_spark(), a.csv)
    from sentiscope.sources.fixtures import labelled

    return labelled(_spark(), a.data)


def cmd_train(a):
    from sentiscope.operators.prepare import sample_head
    from sentiscope.plans import registry
    from sentiscope.plans.train import train_and_save

    rows = _labelled(a)
    rows = sample_head(rows, a.sample_size) if a.sample_size else rows
    _, path, metrics = train_and_save(rows, a.models, version=a.version, resample=a.resample)
    if a.serve:
        registry.serve(_spark(), a.models, path.rsplit("/v=", 1)[1])
    print(json.dumps({"model": path, "metrics": metrics}, default=str))


def cmd_tune(a):
    from sentiscope.operators.tuning import trial_ranking
    from sentiscope.plans import registry, search

    log_path, rows = f"{a.out}/log", _labelled(a)
    if a.models:
        told = registry.tune_and_serve(rows, a.models, log_path, version=a.version, steps=a.steps, sample_size=a.sample_size)
    else:
        train, val, _ = search.search_splits(rows, a.sample_size)
        best, metrics, _ = search.simulated_annealing(train, val, steps=a.steps, sample_size=a.sample_size, log_path=log_path)
        told = {"config": best, "macro_f1": metrics["macro_f1"]}
    log = search.read_trial_log(_spark(), log_path)
    search.write_trial_log(log.orderBy("step"), f"{a.out}/trials_csv")
    trial_ranking(log).write.mode("overwrite").parquet(f"{a.out}/ranking")
    print(json.dumps(told, default=str))


def cmd_export(a):
    from sentiscope.operators import prepare as P
    from sentiscope.sources import files

    _, _, test = P.split_frames(_labelled(a))
    files.export_jsonl(test, a.out, order="doc_id")


def cmd_publish(a):
    from sentiscope.streaming import publish

    msgs = publish.messages_from_export(_spark(), a.exported, start_row=a.start_row)
    if a.kafka:
        publish.publish_kafka(msgs, a.kafka, a.topic, index="row_index")
    else:
        publish.publish_files(msgs, a.out, index="row_index", rows_per_file=a.rows_per_file)


def cmd_stream(a):
    from sentiscope.plans.model import load
    from sentiscope.plans.registry import ServedModel
    from sentiscope.streaming import sink, sources
    from sentiscope.streaming.parse import parse_messages
    from sentiscope.streaming.predict import scored_stream

    spark = _spark()
    messages = (sources.kafka_messages(spark, a.kafka, a.topic) if a.kafka
                else sources.file_messages(spark, a.messages, a.files_per_trigger))
    trigger = {"availableNow": True} if a.once else {"processingTime": a.interval}
    if a.models:
        query, _ = sink.start(parse_messages(messages), a.store, a.checkpoint, trigger=trigger, scorer=ServedModel(spark, a.models).score)
    else:
        query, _ = sink.start(scored_stream(messages, load(a.model)), a.store, a.checkpoint, trigger=trigger)
    query.awaitTermination()


def cmd_progress(a):
    from sentiscope.streaming import progress, sink

    run = sink.run_id_of(_spark(), a.checkpoint)
    progress.batch_progress(_spark(), a.store, a.checkpoint, run).orderBy("batch_id").show(truncate=False)
    if a.messages:
        progress.file_lag(_spark(), a.messages, a.checkpoint).show()


def cmd_compact(a):
    from sentiscope.sources.store import compact_batches

    print(json.dumps({"rows": compact_batches(_spark(), a.store, a.source, a.up_to_batch)}))


def cmd_report(a):
    from sentiscope.operators import monitor as M
    from sentiscope.plans import report
    from sentiscope.sources.store import read_store

    store = read_store(_spark(), a.store)
    latest = M.latest_predictions(store, sentiment=a.sentiment, score=a.score, batch=a.batch, limit=a.limit)
    report.write_report(report.report_tables(M.analytics_scan(store), latest), a.out)


def main(argv=None):
    p = argparse.ArgumentParser(prog="sentiscope")
    sub = p.add_subparsers(dest="cmd", required=True)
    def reviews(parser):
        given = parser.add_mutually_exclusive_group(required=True)
        given.add_argument("--csv")
        given.add_argument("--data")

    t = sub.add_parser("train")
    reviews(t)
    t.add_argument("--models", required=True)
    t.add_argument("--version")
    t.add_argument("--sample-size", type=int)
    t.add_argument("--resample", default="none", choices=["none", "oversample", "oversample_75", "undersample"])
    t.add_argument("--serve", action="store_true")
    t.set_defaults(fn=cmd_train)
    u = sub.add_parser("tune")
    reviews(u)
    u.add_argument("--out", required=True)
    u.add_argument("--steps", type=int, default=8)
    u.add_argument("--sample-size", type=int)
    u.add_argument("--models")
    u.add_argument("--version")
    u.set_defaults(fn=cmd_tune)
    e = sub.add_parser("export")
    reviews(e)
    e.add_argument("--out", required=True)
    e.set_defaults(fn=cmd_export)
    b = sub.add_parser("publish")
    b.add_argument("--exported", required=True)
    b.add_argument("--out")
    b.add_argument("--rows-per-file", type=int, default=50_000)
    b.add_argument("--start-row", type=int, default=0)
    b.add_argument("--kafka")
    b.add_argument("--topic", default="reviews")
    b.set_defaults(fn=cmd_publish)
    s = sub.add_parser("stream")
    model = s.add_mutually_exclusive_group(required=True)
    model.add_argument("--model")
    model.add_argument("--models")
    s.add_argument("--messages")
    s.add_argument("--kafka")
    s.add_argument("--topic", default="reviews")
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--files-per-trigger", type=int, default=1)
    s.add_argument("--interval", default="5 seconds")
    s.add_argument("--once", action="store_true")
    s.set_defaults(fn=cmd_stream)
    g = sub.add_parser("progress")
    g.add_argument("--store", required=True)
    g.add_argument("--checkpoint", required=True)
    g.add_argument("--messages")
    g.set_defaults(fn=cmd_progress)
    c = sub.add_parser("compact")
    c.add_argument("--store", required=True)
    c.add_argument("--source", required=True)
    c.add_argument("--up-to-batch", type=int, required=True)
    c.set_defaults(fn=cmd_compact)
    r = sub.add_parser("report")
    r.add_argument("--store", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--sentiment", default="All")
    r.add_argument("--score", default="All")
    r.add_argument("--batch", default="All")
    r.add_argument("--limit", type=int, default=1000)
    r.set_defaults(fn=cmd_report)
    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
