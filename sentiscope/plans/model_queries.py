"""Registered model / tuning queries.

Model outputs depend on the optimiser, so ``predict_batch``, ``model_metrics``
and the trial-log queries have no SQL oracle (rows-only check); their behaviour
is covered by ``tests/test_stream_and_model.py`` and ``tests/test_literal_fixtures.py``.
``decode_prediction`` is relational and has an oracle.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.catalog import register
from sentiscope.functions.labels import decode_prediction
from sentiscope.functions.probability import confidence
from sentiscope.operators import evaluate as V
from sentiscope.operators import features as FE
from sentiscope.operators import prepare as P
from sentiscope.operators import tuning as TU
from sentiscope.plans import model as MD
from sentiscope.plans import search as SR
from sentiscope.plans.baseline import counted_texts, fit_baseline, fit_counted
from sentiscope.plans.train import RESAMPLING, resampled
from sentiscope.sources.fixtures import labelled, scored, trials
from sentiscope.sources.tables import fingerprint

_LOGS: dict = {}
_MODELS: dict = {}


def _splits(spark, sf):
    train, val, test = P.split_frames(labelled(spark, sf))
    return P.add_class_weights(train), val, test


def _trial_log(spark, sf):
    """The log of one search per session and input, read from the files that the search wrote trial by trial."""
    import uuid

    from sentiscope.session import scratch_path

    key = fingerprint(spark, sf, "documents", "labels")
    if key not in _LOGS:
        train, val, _ = SR.search_splits(labelled(spark, sf))
        path = scratch_path(spark, f"trials-{uuid.uuid4().hex[:12]}")
        SR.simulated_annealing(train, val, log_path=path)
        _LOGS[key] = path
    return SR.read_trial_log(spark, _LOGS[key])


def trained_model(spark, sf):
    """The model of the training job, as the scoring jobs see it: fitted once on the
    weighted training split, saved under the shared checkpoint folder, loaded back."""
    import uuid

    from sentiscope.session import scratch_path

    key = fingerprint(spark, sf, "documents", "labels")
    if key not in _MODELS:
        train, _, _ = _splits(spark, sf)
        fitted = MD.fit(train, **MD.FINAL_CONFIG)
        _MODELS[key] = MD.save(fitted, MD.versioned_path(scratch_path(spark, "models"), uuid.uuid4().hex[:12]))
    return MD.load(_MODELS[key])


@register("predict_batch")
def q_predict_batch(spark, sf):
    _, val, test = _splits(spark, sf)
    fitted = trained_model(spark, sf)
    both = val.withColumn("split", F.lit("val")).unionByName(test.withColumn("split", F.lit("test")))
    out = MD.score(fitted, both, keep=("doc_id", "split", "label"))
    return out.select("doc_id", "split", "label", "prediction", "predicted_label",
                      confidence("probability").alias("confidence"))


@register("model_metrics")
def q_model_metrics(spark, sf):
    _, val, _ = _splits(spark, sf)
    fitted = trained_model(spark, sf)
    labels = MD.label_order(fitted)
    return V.metrics_record(fitted.transform(val), labels=tuple(labels))


@register("decode_prediction", """
WITH c AS (SELECT label, count(*) AS n FROM labelled GROUP BY label),
o AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx FROM c)
SELECT s.event_id, s.prediction, COALESCE(o.label, 'unknown') AS predicted_label
FROM scored s LEFT JOIN o ON s.prediction = o.idx
""", ("labelled", "scored"))
def q_decode_prediction(spark, sf):
    # the rating bands are three, so the label array is small
    labels = [r["label"] for r in FE.label_index_table(labelled(spark, sf)).orderBy("label_index").collect()]
    return scored(spark, sf).select("event_id", "prediction",
                                    decode_prediction("prediction", labels).alias("predicted_label"))


@register("trial_log")
def q_trial_log(spark, sf):
    return _trial_log(spark, sf)


@register("trial_ranking")
def q_trial_ranking(spark, sf):
    return TU.trial_ranking(_trial_log(spark, sf)).select(
        "rank", "step", "macro_f1", "accuracy", "vocab_size", "min_df", "max_iter", "reg_param")


@register("best_trial")
def q_best_trial(spark, sf):
    return TU.best_trial(_trial_log(spark, sf)).select(
        "step", "macro_f1", "vocab_size", "min_df", "max_iter", "reg_param")


@register("acceptance_prob")
def q_acceptance_prob(spark, sf):
    return TU.with_acceptance(_trial_log(spark, sf)).select(
        "step", "accepted", "temperature", "current_macro_f1", "macro_f1", "acceptance_probability")


# The same operators over a trial log derived from the tables, where SQL gives the exact result.
@register("ranked_trials", """
SELECT CAST(row_number() OVER (ORDER BY macro_f1 DESC, step) AS INT) AS rank, step, macro_f1, accuracy FROM trials
""", ("trials",))
def q_ranked_trials(spark, sf):
    return TU.trial_ranking(trials(spark, sf)).select("rank", "step", "macro_f1", "accuracy")


@register("best_of_trials", """
SELECT step, macro_f1, accuracy FROM trials ORDER BY macro_f1 DESC, step LIMIT 1
""", ("trials",))
def q_best_of_trials(spark, sf):
    return TU.best_trial(trials(spark, sf)).select("step", "macro_f1", "accuracy")


@register("trial_acceptance", """
WITH c AS (SELECT *, last_value(CASE WHEN accepted THEN macro_f1 END IGNORE NULLS)
                       OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS current_macro_f1 FROM trials)
SELECT step, accepted, current_macro_f1, macro_f1,
       round(CASE WHEN current_macro_f1 IS NULL OR macro_f1 >= current_macro_f1 THEN 1.0
                  ELSE exp((macro_f1 - current_macro_f1) / temperature) END, 9) AS acceptance_probability
FROM c
""", ("trials",))
def q_trial_acceptance(spark, sf):
    return TU.with_acceptance(trials(spark, sf)).select(
        "step", "accepted", "current_macro_f1", "macro_f1", F.round("acceptance_probability", 9).alias("acceptance_probability"))


@register("baseline_metrics")
def q_baseline_metrics(spark, sf):
    """Experiments' baseline: plain LR on smooth-IDF / L2 TF-IDF of the cleaned text, scored on val."""
    train, val, _ = P.split_frames(labelled(spark, sf))
    return fit_baseline(train, max_iter=10).metrics(val)


@register("resampled_baseline_metrics")
def q_resampled_baseline_metrics(spark, sf):
    """The baseline fitted on the training split after each way of resampling, all scored on the same val rows.

    The texts of the splits are counted once; what is resampled are the rows' numbers.  The fits are independent of each
    other and mostly wait for short jobs, so they run side by side.
    """
    train, val, _ = P.split_frames(labelled(spark, sf))
    texts, scored_texts = counted_texts(train.na.drop(subset=["text"]), keep=("doc_id",)), counted_texts(val)
    rows = texts.select("doc_id", "label", "row")

    def one(how):
        return (fit_counted(texts, resampled(rows, how, needs=()), max_iter=10).metrics_counted(scored_texts)
                .withColumn("resampling", F.lit(how)))

    ways = [how for how in RESAMPLING if how != "none"]
    with ThreadPoolExecutor(len(ways)) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, ways))
