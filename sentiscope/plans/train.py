"""Training job: prepare -> split -> resample -> weight -> fit -> save -> evaluate.

One ingest of the labelled reviews, a deterministic hash split, class weights
from the training split only, a fit of the chosen configuration, a versioned
save, and one confusion matrix per evaluation split from which every metric is
derived.  The training split alone can be resampled; validation and test rows stay as they
are, and the class weights are those of the rows that are fitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from sentiscope.operators import prepare as P
from sentiscope.operators import sampling as S
from sentiscope.operators.evaluate import metrics_record
from sentiscope.plans import model as MD

# The experiments' ways to balance the training split, by name.
RESAMPLING = {
    "none": lambda train, key: train,
    "oversample": lambda train, key: S.oversample(train, key=key).drop("is_original"),
    "oversample_75": lambda train, key: S.oversample(train, key=key, ratio=0.75).drop("is_original"),
    "undersample": lambda train, key: S.undersample(train, key=key),
}


def resampled(train: DataFrame, how: str = "none", key: str = "doc_id", needs: tuple[str, ...] = ("text",)) -> DataFrame:
    """The training rows after one of :data:`RESAMPLING`; the columns are those of ``train``.

    Rows without a text, which no fit uses, go first: they would count in the class sizes (``needs``: no column, for rows that are
    chosen already).
    """
    usable = train.na.drop(subset=list(needs)) if needs else train
    return RESAMPLING[how](usable, key).select(*train.columns)


def train_and_save(labelled: DataFrame, model_base: str, config: dict | None = None,
                   version: str | None = None, evaluate_test: bool = True, resample: str = "none"):
    """Returns ``(model, path, {"val": metrics, "test": metrics})``.

    The test split is scored only when ``evaluate_test`` is set (after model
    selection), as in the original workflow.
    """
    config = dict(config or MD.FINAL_CONFIG)
    train, val, test = P.split_frames(labelled)
    model = MD.fit(P.add_class_weights(resampled(train, resample)), **config)
    path = MD.save(model, MD.versioned_path(model_base, version))
    labels = tuple(MD.label_order(model))
    metrics = {"val": metrics_record(model.transform(val.na.drop(subset=["text"])), labels=labels).first().asDict()}
    if evaluate_test:
        metrics["test"] = metrics_record(model.transform(test.na.drop(subset=["text"])),
                                         labels=labels).first().asDict()
    return model, path, metrics
