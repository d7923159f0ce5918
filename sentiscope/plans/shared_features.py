"""What the trials of a search share: stored tokens, stored term statistics, the label order.

The texts are tokenised once.  Term counts and document frequencies of the training split are
stored per term; a trial's vocabulary is the top of that table, and its IDF comes from the same rows, so a
trial refits neither.  The texts' counts of all terms that any trial takes (the pool) are stored once as numbers: a
trial reads no string.  What a trial fits is the classifier.  On the driver are only the trials'
vocabularies (``vocab_size``, a parameter of the search).
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.functions import text as X
from sentiscope.operators import features as FE
from sentiscope.operators.evaluate import metrics_record
from sentiscope.session import stored

BRANCHES = {"filtered_words": "unigram", "bigrams": "bigram"}


class SharedFeatures:
    """Tokens and statistics of a weighted training split and a validation split.

    ``vocabularies`` are the ``(vocab_size, min_df)`` that trials will ask for; further ones make the pool grow.
    """

    def __init__(self, train: DataFrame, val: DataFrame, vocabularies=()):
        self.train = stored(_tokens(train), "search-train")
        self.val = stored(_tokens(val), "search-val")
        self.stats = {terms: stored(FE.term_stats_from_stored(self.train, terms), f"search-{name}")
                      for terms, name in BRANCHES.items()}
        self.n_train = self.train.count()
        self.labels = StringIndexer(inputCol="label", outputCol="label_index").fit(self.train)
        self.vocabularies, self.pools, self.counted = list(vocabularies), {}, {}

    def _vocabulary(self, terms: str, vocab_size: int, min_df: float) -> list:
        return FE.vocabulary(None, vocab_size, min_df, n_docs=F.lit(self.n_train), stats=self.stats[terms]).orderBy("term_index").collect()

    def _cover(self, branches: list[str], vocab_size: int, min_df: float) -> dict[str, dict[str, float]]:
        """The trial's weights per branch and term; texts are counted anew only if a term is not in the pool."""
        found = {t: {r["term"]: math.log((self.n_train + 1) / (r["df"] + 1)) for r in self._vocabulary(t, vocab_size, min_df)} for t in branches}
        if any(t not in self.pools or not found[t].keys() <= self.pools[t].keys() for t in branches):
            for terms in branches:
                pool = self.pools.setdefault(terms, {})
                for size, least in self.vocabularies if not pool else ():
                    pool |= dict.fromkeys(r["term"] for r in self._vocabulary(terms, size, least))
                pool |= dict.fromkeys(found[terms])
            stages = PipelineModel([*(self._counts(t) for t in self.pools), self.labels])
            self.counted = {name: stored(stages.transform(frame).select("label_index", "class_weight", *(f"{BRANCHES[t]}_features_raw" for t in self.pools)),
                                         f"search-{name}-counts") for name, frame in (("train", self.train), ("val", self.val))}
        return found

    def _counts(self, terms: str) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(list(self.pools[terms]), inputCol=terms, outputCol=f"{BRANCHES[terms]}_features_raw")

    def _scaled(self, terms: str, weights: dict[str, float]) -> ElementwiseProduct:
        """Counts scaled by ``ln((N + 1) / (df + 1))``; a term of the pool that is not the trial's has the weight 0, which is no feature."""
        out = f"{BRANCHES[terms]}_features"
        return ElementwiseProduct(scalingVec=Vectors.dense([weights.get(t, 0.0) for t in self.pools[terms]]), inputCol=f"{out}_raw", outputCol=out)

    def _fit(self, vocab_size: int, min_df: float, max_iter: int, reg_param: float, use_bigrams: bool):
        """``(branches, stages from the stored counts to the vectors, classifier)``."""
        branches = list(BRANCHES) if use_bigrams else ["filtered_words"]
        weights = self._cover(branches, vocab_size, min_df)
        stages = [*(self._scaled(t, weights[t]) for t in branches),
                  VectorAssembler(inputCols=[f"{BRANCHES[t]}_features" for t in branches], outputCol="features")]
        # the classifier keeps its own blocks of rows; the counts are read twice
        vectors = PipelineModel(stages).transform(self.counted["train"]).select("features", "label_index", "class_weight")
        classifier = LogisticRegression(featuresCol="features", labelCol="label_index", weightCol="class_weight",
                                        maxIter=max_iter, regParam=reg_param).fit(vectors)
        return branches, stages, classifier

    def fit(self, vocab_size: int, min_df: float, max_iter: int, reg_param: float, use_bigrams: bool) -> PipelineModel:
        """A trial's model over stored tokens (``filtered_words``, ``bigrams``, ``label``, ``class_weight``)."""
        branches, stages, classifier = self._fit(vocab_size, min_df, max_iter, reg_param, use_bigrams)
        return PipelineModel([*(self._counts(t) for t in branches), *stages, self.labels, classifier])

    def score(self, config: dict) -> dict:
        """Metrics of one configuration on the validation split."""
        _, stages, classifier = self._fit(**config)
        scored = PipelineModel([*stages, classifier]).transform(self.counted["val"])
        return metrics_record(scored, labels=tuple(self.labels.labels)).first().asDict()


def _tokens(frame: DataFrame) -> DataFrame:
    """Tokens and bigrams of the labelled texts, and the weight (1 without one)."""
    words = X.remove_stopwords(X.tokenize("text"))
    weight = F.col("class_weight") if "class_weight" in frame.columns else F.lit(1.0)
    # a small join of texts comes in fewer parts than there are cores
    spark = frame.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = frame.na.drop(subset=["text"]).select("label", "text", weight.alias("class_weight")).repartition(parts)
    return (rows.select("label", "class_weight", words.alias("filtered_words"))
            .withColumn("bigrams", X.bigrams("filtered_words")))
