"""Model versions: saved beside each other, one of them served.

``base/v=<version>`` holds a saved pipeline, ``base/_current`` names the served one and is replaced in one step after the
new version is complete.  ``ServedModel`` looks at the pointer for every batch, so a stream goes over to a new version
without a restart.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiscope.plans import model as MD
from sentiscope.plans import search
from sentiscope.plans.train import train_and_save
from sentiscope.sources import shared_files


def serve(spark: SparkSession, base: str, version: str) -> None:
    """Make a saved version the served one."""
    if f"v={version}" not in shared_files.names(spark, base):
        raise FileNotFoundError(f"no version {version} under {base}")
    shared_files.publish(spark, f"{base.rstrip('/')}/_current", version)


def served_version(spark: SparkSession, base: str) -> str | None:
    return shared_files.read_text(spark, f"{base.rstrip('/')}/_current")


class ServedModel:
    """The served model of a folder, loaded again when the pointer has moved."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.version, self._model = spark, base.rstrip("/"), None, None

    def current(self) -> tuple[str, PipelineModel]:
        version = served_version(self.spark, self.base)
        if version is None:
            raise FileNotFoundError(f"no served model under {self.base}")
        if version != self.version:
            self._model, self.version = MD.load(MD.versioned_path(self.base, version)), version
        return self.version, self._model

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows scored by the served version, with its name in ``model_version``."""
        version, fitted = self.current()
        return MD.score(fitted, rows).withColumn("model_version", F.lit(version))


def tune_and_serve(labelled: DataFrame, base: str, log_path: str, version: str | None = None, steps: int = search.MAX_STEPS,
                   sample_size: int | None = None, **search_options) -> dict:
    """Search, refit the best configuration on the whole training split, save it, serve it.

    Returns ``version, config, metrics``.  Stopped during the search it goes on from the log.
    """
    train, val, _ = search.search_splits(labelled, sample_size)
    best, _, _ = search.simulated_annealing(train, val, steps=steps, sample_size=sample_size, log_path=log_path, **search_options)
    _, path, metrics = train_and_save(labelled, base, best, version=version)
    name = path.rsplit("/v=", 1)[1]
    serve(labelled.sparkSession, base, name)
    return {"version": name, "config": best, "metrics": metrics}
