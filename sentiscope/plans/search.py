"""Simulated-annealing search over the model configuration, with a durable log.

The trials share stored tokens and term statistics (``plans.shared_features``); each
one fits a classifier and is evaluated on the validation split, and only its one-row metric
record comes back to the driver.  Every trial is written to the log before the next begins,
together with the state of the walk (random state, temperature, current and best
configuration), so a search that was stopped anywhere goes on from there and ends with the same log.
Repeated configurations are memoised (the walk revisits them) but still logged as their own step.
"""

from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import DataFrame, SparkSession

from sentiscope.operators import prepare as P
from sentiscope.operators.evaluate import metrics_record
from sentiscope.operators.tuning import TRIAL_SCHEMA, acceptance_probability
from sentiscope.plans import model as model_mod
from sentiscope.plans.shared_features import SharedFeatures
from sentiscope.sources import shared_files

# Fixed values of the original search space and schedule.
VOCAB_OPTIONS = [10000, 12000, 14000]
MIN_DF_OPTIONS = [3, 4]
MAX_ITER_OPTIONS = [15, 20, 25]
REG_PARAM_OPTIONS = [0.0, 0.000025, 0.00005, 0.0001]
INITIAL_CONFIG = dict(vocab_size=12000, min_df=3, max_iter=20, reg_param=0.00005, use_bigrams=True)
MAX_STEPS = 8
INITIAL_TEMPERATURE = 0.015
COOLING_RATE = 0.70
SEED = 42

SPACE = {"vocab_size": VOCAB_OPTIONS, "min_df": MIN_DF_OPTIONS, "max_iter": MAX_ITER_OPTIONS,
         "reg_param": REG_PARAM_OPTIONS}
CONFIG = ("vocab_size", "min_df", "max_iter", "reg_param", "use_bigrams")


def neighbor_config(config: dict, rng: random.Random, space: dict = SPACE) -> dict:
    """Move one parameter to an adjacent option of its list."""
    new = dict(config)
    name = rng.choice(list(space))
    options = space[name]
    i = options.index(new[name])
    steps = [j for j in (i - 1, i + 1) if 0 <= j < len(options)]
    new[name] = options[rng.choice(steps)]
    return new


def train_and_score(train: DataFrame, val: DataFrame, config: dict) -> dict:
    """A whole pipeline fitted and scored (what a trial's shared features stand for)."""
    fitted = model_mod.fit(train, **config)
    labels = model_mod.label_order(fitted)
    scored = fitted.transform(val.na.drop(subset=["text"]))
    rec = metrics_record(scored, labels=tuple(labels))
    return rec.first().asDict()


def _record(step, accepted, temperature, config, metrics, sample_size):
    row = {"step": step, "timestamp": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           "accepted": accepted, "temperature": temperature, "sample_size": sample_size}
    row.update({k: config[k] for k in CONFIG})
    row.update(metrics)
    return row


class Walk:
    """State of a search: what the next step depends on."""

    def __init__(self, config: dict, temperature: float, seed: int):
        self.rng = random.Random(seed)
        self.temperature = temperature
        self.current, self.score = dict(config), None
        self.best, self.best_metrics = None, None

    def state(self) -> dict:
        version, words, gauss = self.rng.getstate()
        return {"random": [version, list(words), gauss], "temperature": self.temperature, "current": self.current,
                "score": self.score, "best": self.best, "best_metrics": self.best_metrics}

    def restore(self, state: dict) -> None:
        version, words, gauss = state["random"]
        self.rng.setstate((version, tuple(words), gauss))
        self.temperature, self.current, self.score = state["temperature"], state["current"], state["score"]
        self.best, self.best_metrics = state["best"], state["best_metrics"]

    def take(self, config: dict, metrics: dict, accepted: bool) -> None:
        score = metrics["macro_f1"]
        if accepted:
            self.current, self.score = dict(config), score
        if self.best is None or score > self.best_metrics["macro_f1"]:  # the first of equal ones stays
            self.best, self.best_metrics = dict(config), dict(metrics)


class TrialLog:
    """An append-only folder: one file per trial with its record and the walk's state behind it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, record: dict, walk: Walk) -> None:
        entry = {**record, "timestamp": record["timestamp"].isoformat(), "walk": walk.state()}
        shared_files.publish(self.spark, f"{self.path}/trial-{record['step']:06d}.json", json.dumps(entry))

    def entries(self) -> list[dict]:
        """All logged trials in order (one per model fit, so a short list)."""
        found = [json.loads(shared_files.read_text(self.spark, f"{self.path}/{n}")) for n in shared_files.names(self.spark, self.path)]
        return [{**e, "timestamp": dt.datetime.fromisoformat(e["timestamp"])} for e in found]


def read_trial_log(spark: SparkSession, path: str) -> DataFrame:
    """The logged trials as a table."""
    return spark.read.schema(TRIAL_SCHEMA).json(f"{path.rstrip('/')}/trial-*.json")


def simulated_annealing(train: DataFrame, val: DataFrame, steps: int = MAX_STEPS,
                        initial: dict | None = None, space: dict = SPACE,
                        temperature: float = INITIAL_TEMPERATURE, cooling: float = COOLING_RATE,
                        seed: int = SEED, sample_size: int | None = None, on_trial=None,
                        scorer=None, log_path: str | None = None):
    """Run the search; returns ``(best_config, best_metrics, trial_log DataFrame)``.

    With ``log_path`` every trial is logged there, and the search goes on behind the last logged one; ``train``,
    ``val``, ``space`` and ``cooling`` must be those it began with.  ``on_trial(trials_so_far)`` is called after every trial.
    The logged temperature is the one in force at that step (before
    cooling).  The best configuration changes only on a strictly better score.  ``scorer(train, val, config)`` scores
    a configuration; by default the trials share stored tokens and statistics.
    """
    spark = train.sparkSession
    log = TrialLog(spark, log_path) if log_path else None
    walk = Walk(initial or INITIAL_CONFIG, temperature, seed)
    trials = log.entries() if log else []
    if trials:
        walk.restore(trials[-1]["walk"])
    memo = {tuple(t[k] for k in CONFIG): {k: t[k] for k in t if k in _METRICS} for t in trials}
    shared = None

    def evaluate(cfg):
        nonlocal shared
        key = tuple(cfg[k] for k in CONFIG)
        if key not in memo:
            if scorer is not None:
                memo[key] = scorer(train, val, cfg)
            else:
                sizes = max([*space.get("vocab_size", []), cfg["vocab_size"]])
                least = {*space.get("min_df", []), cfg["min_df"]}
                shared = shared or SharedFeatures(train, val, [(sizes, m) for m in sorted(least)])
                memo[key] = shared.score({k: cfg[k] for k in CONFIG})
        return memo[key]

    for step in range(len(trials), steps + 1):
        if step == 0:
            cand, accepted = walk.current, True
            metrics = evaluate(cand)
        else:
            cand = neighbor_config(walk.current, walk.rng, space)
            metrics = evaluate(cand)
            accepted = walk.rng.random() < acceptance_probability(walk.score, metrics["macro_f1"], walk.temperature)
        record = _record(step, accepted, walk.temperature, cand, metrics, sample_size)
        walk.take(cand, metrics, accepted)
        if step:
            walk.temperature *= cooling
        trials.append(record)
        if log:
            log.append(record, walk)
        if on_trial:
            on_trial(trials)
    rows = spark.createDataFrame([tuple(t.get(f.name) for f in TRIAL_SCHEMA.fields) for t in trials], TRIAL_SCHEMA)
    return walk.best, walk.best_metrics, rows


_METRICS = {f.name for f in TRIAL_SCHEMA.fields} - {"step", "timestamp", "accepted", "temperature", "sample_size", *CONFIG}


def search_splits(labelled: DataFrame, sample_size: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Weighted training split, validation and test split of the first ``sample_size`` reviews (all without one)."""
    rows = P.sample_head(labelled, sample_size) if sample_size else labelled
    train, val, test = P.split_frames(rows)
    return P.add_class_weights(train), val, test


def write_trial_log(trials: DataFrame, path: str) -> None:
    """CSV with header, rewritten as a whole (the log is one row per trial)."""
    trials.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
