"""Arithmetic fixtures taken from the published numbers of the original project."""

import pytest
from pyspark.sql import functions as F

from sentiscope.operators import evaluate as V
from sentiscope.operators import prepare as P
from sentiscope.operators import tuning as TU
from sentiscope.plans import search as SR


def _scored_from_cells(spark, cells):
    rows = [(float(a), float(p), n) for (a, p), n in cells.items()]
    df = spark.createDataFrame(rows, "label_index double, prediction double, n long")
    return df.select("label_index", "prediction", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))


def test_class_weights_from_published_counts(spark):
    counts = {"positive": 61252, "negative": 12203, "neutral": 6446}
    rows = [(lbl,) for lbl, n in counts.items() for _ in range(n)]
    train = spark.createDataFrame(rows, "label string")
    got = {r["label"]: round(r["class_weight"], 4) for r in P.class_weight_table(train).collect()}
    assert got == {"positive": 0.4348, "negative": 2.1826, "neutral": 4.1318}


def test_per_class_metrics_from_published_confusion_counts(spark):
    # diagonal 691 / 90 / 22, actual totals 761 / 153 / 86, predicted totals 785 / 153 / 62
    cells = {(0, 0): 691, (0, 1): 43, (0, 2): 27, (1, 0): 50, (1, 1): 90, (1, 2): 13,
             (2, 0): 44, (2, 1): 20, (2, 2): 22}
    scored = _scored_from_cells(spark, cells)
    m = {r["class_index"]: r for r in V.class_metrics(scored).collect()}
    assert [m[c]["true_positive"] for c in (0.0, 1.0, 2.0)] == [691, 90, 22]
    assert [m[c]["actual_total"] for c in (0.0, 1.0, 2.0)] == [761, 153, 86]
    assert [m[c]["predicted_total"] for c in (0.0, 1.0, 2.0)] == [785, 153, 62]
    assert [round(m[c]["f1_score"], 6) for c in (0.0, 1.0, 2.0)] == [0.893920, 0.588235, 0.297297]
    assert V.accuracy(scored).first()["accuracy"] == pytest.approx(0.803)
    rec = V.metrics_record(scored).first()
    assert rec["macro_f1"] == pytest.approx((0.8939197930142303 + 0.5882352941176471 + 0.2972972972972973) / 3)


def test_absent_class_scores_zero(spark):
    cells = {(0, 0): 5, (0, 1): 1, (1, 1): 4, (2, 0): 3, (2, 1): 2}
    m = {r["class_index"]: r for r in V.class_metrics(_scored_from_cells(spark, cells)).collect()}
    assert m[2.0]["f1_score"] == 0.0 and m[2.0]["precision"] == 0.0 and m[2.0]["recall"] == 0.0
    macro = V.macro_f1(_scored_from_cells(spark, cells)).first()["macro_f1"]
    assert macro == pytest.approx((m[0.0]["f1_score"] + m[1.0]["f1_score"]) / 3)


# macro-F1 of the nine logged trials (step -> score) of the original search
PUBLISHED_TRIALS = {0: 0.6404388933614492, 1: 0.641063141735975, 2: 0.641874127239792,
                    3: 0.6402196011678034, 4: 0.641874127239792, 5: 0.641063141735975,
                    6: 0.6411260973009402, 7: 0.6468522581494559, 8: 0.6470225137073925}


def test_trial_ranking_and_best_reproduce_published_report(spark):
    trials = spark.createDataFrame(sorted(PUBLISHED_TRIALS.items()), "step int, macro_f1 double")
    ranked = [r["step"] for r in TU.trial_ranking(trials).collect()]
    assert ranked == [8, 7, 2, 4, 6, 1, 5, 0, 3]
    best = TU.best_trial(trials).collect()
    assert [r["step"] for r in best] == [8]
    assert round(best[0]["macro_f1"], 6) == 0.647023


def test_temperature_schedule_and_memoisation(spark):
    calls = []

    def fake_scorer(train, val, cfg):
        calls.append(tuple(sorted(cfg.items())))
        s = 0.6 + cfg["vocab_size"] / 1e6 - cfg["reg_param"]
        keys = ["accuracy", "macro_f1", "positive_f1", "negative_f1", "neutral_f1",
                "positive_precision", "positive_recall", "negative_precision", "negative_recall",
                "neutral_precision", "neutral_recall"]
        return {k: s for k in keys}

    tiny = spark.range(1)
    _, _, log = SR.simulated_annealing(tiny, tiny, steps=8, scorer=fake_scorer)
    temps = [r["temperature"] for r in log.orderBy("step").collect()]
    assert temps[0] == temps[1] == 0.015
    assert temps[2] == pytest.approx(0.015 * 0.7)
    assert temps[8] == pytest.approx(0.015 * 0.7 ** 7)
    assert len(calls) == len(set(calls))            # repeated configurations are not refitted
    assert log.count() == 9


def test_acceptance_probability():
    assert TU.acceptance_probability(0.6, 0.61, 0.01) == 1.0
    assert TU.acceptance_probability(0.6, 0.59, 0.01) == pytest.approx(2.718281828 ** -1, rel=1e-6)


def test_macro_f1_evaluator(spark):
    cells = {(0, 0): 691, (0, 1): 43, (0, 2): 27, (1, 0): 50, (1, 1): 90, (1, 2): 13,
             (2, 0): 44, (2, 1): 20, (2, 2): 22}
    ev = V.MacroF1Evaluator()
    got = ev.evaluate(_scored_from_cells(spark, cells))
    assert got == pytest.approx((0.8939197930142303 + 0.5882352941176471 + 0.2972972972972973) / 3)
    assert ev.isLargerBetter()
