"""Training on resampled rows: sizes, untouched evaluation rows, the saved model, the command line."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sentiscope import catalog, cli
from sentiscope.operators import prepare as P
from sentiscope.plans import model as MD
from sentiscope.plans.train import RESAMPLING, resampled, train_and_save

SMALL = dict(vocab_size=200, min_df=1, max_iter=3, reg_param=0.01, use_bigrams=False)


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [(i, f"{w} product number {i % 7} {w}", label) for i, (w, label) in enumerate(
        [("great", "positive")] * 150 + [("awful", "negative")] * 40 + [("plain", "neutral")] * 25)]
    return spark.createDataFrame([*rows, *((1000 + i, None, "neutral") for i in range(40))],
                                 "doc_id long, text string, label string").repartition(3).persist()


def _sizes(df):
    return {r.label: r["count"] for r in df.groupBy("label").count().collect()}


def test_sizes_after_each_way(reviews):
    train, _, _ = P.split_frames(reviews)
    before = _sizes(train.where("text IS NOT NULL"))
    most, least = max(before.values()), min(before.values())
    want = {"none": before, "oversample": dict.fromkeys(before, most),
            "oversample_75": {k: max(n, int(0.75 * most)) for k, n in before.items()},
            "undersample": {k: n if n == least else (n + least) // 2 for k, n in before.items()}}
    assert want.keys() == RESAMPLING.keys()
    for how, sizes in want.items():
        got = resampled(train, how)
        assert got.columns == train.columns and _sizes(got) == sizes
        # drawn rows are rows of the training split
        assert got.join(train, ["doc_id", "text", "label"], "left_anti").count() == 0


def test_a_model_of_resampled_rows_is_saved_and_evaluated(spark, reviews, tmp_path):
    model, path, metrics = train_and_save(reviews, str(tmp_path), SMALL, version="o", resample="oversample")
    _, _, plain = train_and_save(reviews, str(tmp_path), SMALL, version="n")
    assert path.endswith("v=o") and metrics.keys() == plain.keys() == {"val", "test"}
    assert metrics["val"]["accuracy"] > 0.9 and set(MD.label_order(model)) == {"positive", "negative", "neutral"}
    _, val, _ = P.split_frames(reviews)
    again = MD.load(path).transform(val.na.drop(subset=["text"]))
    right = again.agg(F.avg((F.col("label_index") == F.col("prediction")).cast("double"))).first()[0]
    assert abs(right - metrics["val"]["accuracy"]) < 1e-12  # all validation rows, none drawn


def test_command_line_takes_the_way(monkeypatch, capsys, reviews, tmp_path):
    told = {}
    monkeypatch.setattr(cli, "_labelled", lambda a: reviews)
    monkeypatch.setattr("sentiscope.plans.train.train_and_save",
                        lambda rows, base, **options: told.update(options) or (None, f"{base}/v=x", {}))
    cli.main(["train", "--data", "unused", "--models", str(tmp_path), "--resample", "undersample"])
    assert told["resample"] == "undersample"
    with pytest.raises(SystemExit):
        cli.main(["train", "--data", "unused", "--models", str(tmp_path), "--resample", "other"])


def test_baseline_is_scored_after_each_way(spark):
    catalog.load_all()
    rows = catalog.QUERIES["resampled_baseline_metrics"](spark, SF_SMALL).collect()
    assert sorted(r.resampling for r in rows) == ["oversample", "oversample_75", "undersample"]
    assert all(0 <= r.accuracy <= 1 and 0 <= r.macro_f1 <= 1 for r in rows)
