"""The experiments' baseline, fitted with a vocabulary that no machine has to hold.

Smooth-IDF, L2-normalised TF-IDF of the cleaned text and an unweighted logistic regression, as
``plans.model.fit_smooth_tfidf_baseline`` fits them with Spark ML: standardised features, intercepts of the class
sizes, L-BFGS.  There the vocabulary, the coefficients and the optimiser's history lie on the driver; they grow with the corpus.

Every point that L-BFGS visits is a sum of the gradients seen so far, and a gradient is ``X' r`` with the residuals ``r`` of the rows.
So the search is kept as numbers per gradient: its inner products are ``r_i . (X X' r_j)``.  Per training row and
gradient the products ``z = X X' r`` are stored (a number per class); margins and losses along a direction, and
with them the line search, are sums of them.  A gradient is two passes over the entries: ``X'``, then ``X``.

The ``DENSE_TERMS`` terms of most documents have their sums as one bounded array, that is sent to the tasks;
all other terms are rows, joined and summed by term.  No term is left out.

Rows that are drawn several times (``fit_counted``) are kept once, with the number of draws as their weight in every sum;
texts are counted once for all fits over them.  Every task of a pass sends an array of the dense terms' sums, so a pass has no
more tasks than the entries need (``ENTRIES_PER_TASK``) or, with few entries, keep busy.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiscope.operators.evaluate import metrics_record
from sentiscope.plans.lbfgs import Search
from sentiscope.plans.model import clean_tokens_sql
from sentiscope.session import stored

DENSE_TERMS = 1 << 17   # terms whose sums are one array
FEW = 4096              # numbers that every task may send as they are
PARTS = 16              # pieces in which the tasks' arrays are added up
SMALLEST = 1e-13        # a variance below this share of the mean square is that of a constant
FEWEST_ENTRIES, ENTRIES_PER_TASK = 1 << 18, 1 << 22

STATE = "row long, label_index double, m long, z binary"
SPLIT = "row long, label_index double, m long, idx binary, tf binary, terms array<string>, counts array<int>"


# ------------------------------------------------------------------- entries
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's distinct tokens and how often it has them; rows get numbers."""
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        n, tokens = batch.num_rows, batch.column(batch.num_columns - 1)
        coded = tokens.flatten().dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy()
        owner = np.repeat(np.arange(n), pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64))
        keys, counts = np.unique(owner * max(len(words), 1) + codes, return_counts=True)
        ends = np.searchsorted(keys, np.arange(n + 1) * max(len(words), 1)).astype(np.int32)
        terms = words.take(pa.array(keys % max(len(words), 1)))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(at, at + n)), *batch.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), terms),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.int32)))], ["row", *batch.schema.names[:-1], "terms", "counts"])
        at += n


def counted_texts(frame: DataFrame, keep: tuple[str, ...] = (), label_col: str = "label") -> DataFrame:
    """``row, keep..., label, terms, counts`` of labelled texts (null: no terms), stored: row numbers stay."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the library
    tokens = frame.select(*keep, F.col(label_col).cast("string").alias("label"), F.expr(clean_tokens_sql()).alias("tokens"))
    layout = T.StructType([T.StructField("row", T.LongType()), *tokens.schema.fields[:-1], T.StructField("terms", T.ArrayType(T.StringType())),
                           T.StructField("counts", T.ArrayType(T.IntegerType()))])
    return stored(tokens.mapInArrow(_count, layout), "baseline-counted")


def _passes(spark, entries: int) -> int:
    """Tasks of a pass over so many entries."""
    return max(1, min(spark.sparkContext.defaultParallelism, entries // FEWEST_ENTRIES), -(-entries // ENTRIES_PER_TASK))


def _pieces(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary value per row with the row's run of ``values``."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.array([values[a // values.itemsize:b // values.itemsize].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())


def _read(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """``(values, their row in the batch)`` of a column made by :func:`_pieces`."""
    flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    return flat, np.repeat(np.arange(len(column)), sizes)


def _split(counted: DataFrame, dense_terms) -> DataFrame:
    """Entries of the dense terms as arrays of numbers, the others as terms."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(dense_terms.value, pa.string())
        for batch in batches:
            terms, n = batch.column(3), batch.num_rows
            coded = terms.flatten().dictionary_encode()
            place = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy().astype(np.int32)
            at = place[coded.indices.to_numpy()] if len(place) else np.empty(0, np.int32)
            owner = np.repeat(np.arange(n), pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))
            counts = batch.column(4).flatten()
            tf, dense = counts.to_numpy().astype(np.float64), at >= 0
            sizes = np.bincount(owner[dense], minlength=n)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~dense], minlength=n))]).astype(np.int32))
            rest = pa.array(np.flatnonzero(~dense))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], _pieces(at[dense], sizes), _pieces(tf[dense], sizes),
                pa.ListArray.from_arrays(ends, terms.flatten().take(rest)), pa.ListArray.from_arrays(ends, counts.take(rest))],
                ["row", "label_index", "m", "idx", "tf", "terms", "counts"])

    return counted.select("row", "label_index", "m", "terms", "counts").mapInArrow(split, SPLIT)


def _rare(split: DataFrame) -> DataFrame:
    """``row, term, count`` of the entries that are not dense."""
    return split.select("row", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("count"))))


def _by(key: str, left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """A join whose sides both stay on the executors, however small they are."""
    return left.join(right.hint("shuffle_hash"), key, how)


# ---------------------------------------------------------------------- sums
def _summed(frame: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of one bounded array per task: large ones are cut in pieces, that Spark adds up."""
    pieces = PARTS if math.prod(shape) > FEW else 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                some = True
                add(batch, total)
        if some:
            found = [p.tobytes() for p in np.array_split(total.ravel(), pieces)]
            yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([TaskContext.get().partitionId()] * pieces, pa.int32()),
                                              pa.array(found, pa.binary())], ["part", "task", "sums"])

    def together(found: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, np.float64) for s in found.sort_by("task").column("sums").to_pylist())
        return pa.table({"part": found.column("part")[:1], "task": found.column("task")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    layout = "part int, task int, sums binary"
    parts = frame.mapInArrow(sums, layout)
    if pieces == 1:
        return sum((np.frombuffer(r["sums"], np.float64).reshape(shape) for r in parts.collect()), np.zeros(shape))
    rows = parts.groupBy("part").applyInArrow(together, layout).collect()
    return np.frombuffer(b"".join(bytes(r["sums"]) for r in sorted(rows, key=lambda r: r["part"])), np.float64).reshape(shape)


def _norm(sums, squares, n: int):
    """``1 / standard deviation`` of a term's values over all rows; 0 for a constant."""
    spread = squares - sums * sums / n
    return np.where(spread > SMALLEST * squares, np.sqrt(max(n - 1, 1) / np.maximum(spread, 1e-300)), 0.0)


class Entries:
    """Standardised entries of the training rows, and the products with them."""

    def __init__(self, counted: DataFrame, n_classes: int, n: int, dense_terms: int):
        """``counted`` has ``row, label_index, m, terms, counts``: ``m`` rows alike in each, ``n`` in all."""
        self.spark = spark = counted.sparkSession
        self.k, self.n = n_classes if n_classes > 2 else 1, n
        terms = counted.select(F.explode("terms").alias("term"), "m").groupBy("term").agg(F.sum("m").alias("df"), F.count(F.lit(1)).alias("held"))
        idf = F.log(F.lit(self.n + 1.0) / (F.col("df") + 1.0)) + 1.0
        stats = stored(terms.withColumn("idf", idf), "baseline-terms")
        # few: a sum of n different numbers is at least n * n / 2
        sizes = stats.groupBy("df").agg(F.count(F.lit(1)).alias("count"), F.sum("held").alias("held")).collect()
        if not sizes:
            raise ValueError("the training rows have no term")
        self.parts = _passes(spark, sum(r["held"] for r in sizes))
        least, seen = math.inf, 0
        for r in sorted(sizes, key=lambda r: -r["df"]):
            seen += r["count"]
            if seen > dense_terms:
                break
            least = r["df"]
        top = stats.where(F.col("df") >= least).select("term", "idf").orderBy("term").toArrow()  # a row object per term takes ten times that
        self.dense, self.dense_idf = top["term"].to_pylist(), top["idf"].to_numpy()
        self.words = spark.sparkContext.broadcast(self.dense)
        self.some_rare = seen > dense_terms
        rare = stats.where(F.col("df") < least).select("term", "idf").withColumn("tid", F.monotonically_increasing_id())
        self.rare_terms = stored(rare, "baseline-rare-terms")

        split = stored(_split(counted, self.words), "baseline-split")
        weighted = (_by("term", _rare(split), self.rare_terms)
                    .select("row", "tid", (F.col("count") * F.col("idf")).alias("w")))
        dense = split.select("row", "label_index", "m", "idx", "tf")
        if self.some_rare:
            weighted = stored(weighted, "baseline-rare")
            squares = weighted.groupBy("row").agg(F.sum(F.col("w") * F.col("w")).alias("squares"))
            dense = _by("row", dense, squares, "left").fillna(0.0, ["squares"])
        else:
            dense = dense.withColumn("squares", F.lit(0.0))
        self.rows = dense.mapInArrow(self._normalised(), "row long, label_index double, m long, norm double, idx binary, x binary").repartition(
            self.parts, "row").persist(StorageLevel.MEMORY_AND_DISK)
        h = len(self.dense)

        def moments(batch: pa.RecordBatch, total: np.ndarray) -> None:
            idx, (x, owner) = _read(batch.column(0), np.int32)[0], _read(batch.column(1), np.float64)
            mx = x * batch.column(2).to_numpy()[owner]
            total[0] += np.bincount(idx, mx, h)
            total[1] += np.bincount(idx, mx * x, h)

        sums = _summed(self.rows.select("idx", "x", "m"), moments, (2, h))
        self.scale = _norm(sums[0], sums[1], self.n)
        self.centre = sums[0] / self.n * self.scale
        self._scale = spark.sparkContext.broadcast(self.scale)
        if self.some_rare:
            x = _by("row", weighted, self.rows.select("row", "norm", "m")).select("row", "tid", (F.col("w") / F.col("norm")).alias("x"), "m")
            x = stored(x, "baseline-rare-x")
            s, q = F.sum(F.col("x") * F.col("m")), F.sum(F.col("x") * F.col("x") * F.col("m"))
            spread = q - s * s / self.n
            scale = F.when(spread > SMALLEST * q, F.sqrt(F.lit(float(max(self.n - 1, 1))) / spread)).otherwise(F.lit(0.0))
            self.rare_scale = stored(x.groupBy("tid").agg(scale.alias("scale"), (s / self.n).alias("mean"))
                                     .select("tid", "scale", (F.col("mean") * F.col("scale")).alias("centre")), "baseline-rare-scale")
            scaled = stored(_by("tid", x, self.rare_scale).select("row", "tid", (F.col("x") * F.col("scale")).alias("x"), "centre"), "baseline-rare-scaled")
            self.by_row = scaled.repartition(self.parts, "row").persist(StorageLevel.MEMORY_AND_DISK)
            self.by_term = scaled.select("tid", "row", "x").repartition(self.parts, "tid").persist(StorageLevel.MEMORY_AND_DISK)

    def _normalised(self):
        idf = self.spark.sparkContext.broadcast(self.dense_idf)

        def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                (idx, owner), tf = _read(batch.column(3), np.int32), _read(batch.column(4), np.float64)[0]
                w = tf * idf.value[idx]
                norm = np.sqrt(np.bincount(owner, w * w, n) + batch.column(5).to_numpy(zero_copy_only=False))
                x = w / norm[owner]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(norm), batch.column(3),
                                                  _pieces(x, np.bincount(owner, minlength=n))], ["row", "label_index", "m", "norm", "idx", "x"])

        return normalise

    def close(self) -> None:
        for frame in (self.rows, *((self.by_row, self.by_term) if self.some_rare else ())):
            frame.unpersist()

    def gradient(self, residuals: DataFrame):
        """``X' r`` of ``row, r``: the dense terms' array, the other terms' rows ``tid, g``, and the sums of ``r``."""
        h, k, scale = len(self.dense), self.k, self._scale

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            (idx, owner), x = _read(batch.column(0), np.int32), _read(batch.column(1), np.float64)[0]
            r = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(-1, k)
            x = x * scale.value[idx]
            for c in range(k):
                total[:h, c] += np.bincount(idx, x * r[owner, c], h)
            total[h] += r.sum(axis=0)

        sums = _summed(_by("row", self.rows, residuals).select("idx", "x", "r"), add, (h + 1, k))
        total = sums[h]
        dense = sums[:h] - self.centre[:, None] * total
        rare = None
        if self.some_rare:
            spread = self._unpacked(residuals)
            g = [F.sum(F.col("x") * F.col(f"r{c}")) for c in range(k)]
            rare = (_by("row", self.by_row, spread).groupBy("tid").agg(F.first("centre").alias("centre"), *(s.alias(f"g{c}") for c, s in enumerate(g)))
                    .select("tid", "centre", *((F.col(f"g{c}") - F.col("centre") * F.lit(float(total[c]))).alias(f"g{c}") for c in range(k))))
            rare = stored(rare, "baseline-gradient")
        return dense, rare, total

    def _unpacked(self, residuals: DataFrame) -> DataFrame:
        k = self.k

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                r = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, k)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r[:, c].copy()) for c in range(k))],
                                                 ["row", *(f"r{c}" for c in range(k))])

        return residuals.select("row", "r").mapInArrow(unpack, "row long, " + ", ".join(f"r{c} double" for c in range(k)))

    def shift(self, dense: np.ndarray, rare: DataFrame | None) -> np.ndarray:
        """The centres times a vector over the terms: what every row's product is less by."""
        out = self.centre @ dense
        if rare is not None:
            found = rare.agg(*(F.sum(F.col("centre") * F.col(f"g{c}")).alias(f"s{c}") for c in range(self.k))).first()
            out = out + np.array([v or 0.0 for v in found])
        return out

    def products(self, gradient, state: DataFrame) -> DataFrame:
        """``state`` with ``X g`` behind each row's products."""
        dense, rare, total = gradient
        less = self.shift(dense, rare) - total  # the intercepts' part is the sum of the residuals
        weights, k = state.sparkSession.sparkContext.broadcast(dense * self.scale[:, None]), self.k
        frame = _by("row", self.rows.select("row", "idx", "x"), state.select("row", "label_index", "m", "z"))
        names = [f"p{c}" for c in range(k)]
        if rare is not None:
            part = (_by("tid", self.by_term, rare).groupBy("row")
                    .agg(*(F.sum(F.col("x") * F.col(f"g{c}")).alias(f"p{c}") for c in range(k))))
            frame = _by("row", frame, part, "left").fillna(0.0, names)
        else:
            frame = frame.select("*", *(F.lit(0.0).alias(p) for p in names))

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                (idx, owner), x = _read(batch.column(1), np.int32), _read(batch.column(2), np.float64)[0]
                z = np.stack([np.bincount(owner, x * weights.value[idx, c], n) + batch.column(6 + c).to_numpy(zero_copy_only=False) - less[c]
                              for c in range(k)], axis=1) if n else np.empty((0, k))
                longer = [old + new.tobytes() for old, new in zip(batch.column(5).to_pylist(), z)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[3:5], pa.array(longer, pa.binary())], ["row", "label_index", "m", "z"])

        return stored(frame.select("row", "idx", "x", "label_index", "m", "z", *names).mapInArrow(products, STATE), "baseline-state")


# ------------------------------------------------------------------ optimiser
def _margins(z: pa.Array, n: int, k: int, point: np.ndarray, start: np.ndarray) -> np.ndarray:
    if not len(point):
        return np.tile(start, (n, 1))
    return start + np.einsum("njc,j->nc", np.frombuffer(b"".join(z.to_pylist())).reshape(n, -1, k)[:, :len(point)], point)


def _loss(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the loss and its derivative by the margins; a single margin is that of class 1 against 0."""
    full = margins if margins.shape[1] > 1 else np.concatenate([np.zeros_like(margins), margins], axis=1)
    top = full.max(axis=1, keepdims=True)
    e = np.exp(full - top)
    total = e.sum(axis=1, keepdims=True)
    at = np.arange(len(full)), label.astype(int)
    loss = np.log(total[:, 0]) + top[:, 0] - full[at]
    r = e / total
    r[at] -= 1.0
    return loss, r if margins.shape[1] > 1 else r[:, 1:]


class Rows:
    """The search's view of the training rows: losses at sums of gradients, residuals, inner products."""

    def __init__(self, entries: Entries, start: np.ndarray):
        self.entries, self.start, self.k, self.n = entries, start, entries.k, entries.n
        self.state = entries.rows.select("row", "label_index", "m", F.lit(b"").alias("z"))

    def along(self, point: np.ndarray, way: np.ndarray) -> tuple[float, float]:
        """Loss at ``point`` and its slope along ``way``, both given by their shares of the gradients."""
        k, n_all, start = self.k, self.n, self.start

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            n, m = batch.num_rows, batch.column(1).to_numpy() / n_all
            loss, r = _loss(_margins(batch.column(2), n, k, point, start), batch.column(0).to_numpy())
            total += [m @ loss, m @ (r * _margins(batch.column(2), n, k, way, np.zeros(k))).sum(axis=1)]

        value, slope = _summed(self.state.select("label_index", "m", "z"), add, (2,))
        return float(value), float(slope)

    def residuals(self, points: list[np.ndarray], shares: np.ndarray) -> DataFrame:
        """``row, r``: the sum of the residuals at some points, by shares."""
        k, n_all, start = self.k, self.n, self.start

        def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, label, m = batch.num_rows, batch.column(1).to_numpy(), batch.column(2).to_numpy()[:, None] / n_all
                r = sum(s * m * _loss(_margins(batch.column(3), n, k, p, start), label)[1] for p, s in zip(points, shares) if s)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in np.broadcast_to(r, (n, k))], pa.binary())], ["row", "r"])

        return self.state.mapInArrow(residuals, "row long, r binary")

    def add_gradient(self, point: np.ndarray) -> np.ndarray:
        """The gradient at ``point`` becomes the next one; returns its inner products with all of them."""
        self.state = self.entries.products(self.entries.gradient(self.residuals([point], np.ones(1))), self.state)
        k, n_all, start, size = self.k, self.n, self.start, len(point) + 1

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            n, m = batch.num_rows, batch.column(1).to_numpy()[:, None] / n_all
            r = m * _loss(_margins(batch.column(2), n, k, point, start), batch.column(0).to_numpy())[1]
            z = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(n, size, k)
            total += np.einsum("nc,njc->j", r, z)

        return _summed(self.state.select("label_index", "m", "z"), add, (size,))


# ---------------------------------------------------------------------- model
class Baseline:
    """Fitted terms and coefficients: the dense terms' here, the others' as a stored table."""

    label_col = "label"

    def __init__(self, indexer, entries: Entries | None, coefficients=None, start: np.ndarray | None = None):
        self.indexer, self.labels, self.entries = indexer, list(indexer.labels), entries
        if entries is None:  # a single class
            return
        dense, rare, total = coefficients
        self.k, self.words = entries.k, entries.words
        self.intercept = start + total - entries.shift(dense, rare)
        self.dense_idf, self.dense = entries.dense_idf, dense * entries.scale[:, None]
        self.rare = None
        if rare is not None:
            weights = _by("tid", rare.drop("centre"), entries.rare_scale).select(
                "tid", *((F.col(f"g{c}") * F.col("scale")).alias(f"g{c}") for c in range(self.k)))
            self.rare = stored(_by("tid", entries.rare_terms, weights).drop("tid"), "baseline-coefficients")

    def transform(self, frame: DataFrame) -> DataFrame:
        """``label_index, prediction`` of labelled texts (null: a text without words)."""
        if self.entries is None:
            labels = frame.select(F.col(self.label_col).cast("string").alias("label"))
            return self.indexer.transform(labels).select("label_index", F.lit(0.0).alias("prediction"))
        return self.transform_counted(counted_texts(frame, label_col=self.label_col))

    def transform_counted(self, counted: DataFrame) -> DataFrame:
        """:meth:`transform` of what :func:`counted_texts` made of the texts."""
        indexed = self.indexer.transform(counted)
        if self.entries is None:
            return indexed.select("label_index", F.lit(0.0).alias("prediction"))
        split = stored(_split(indexed.withColumn("m", F.lit(1).cast("long")), self.words), "baseline-scored-split")
        k, names = self.k, ["squares", *(f"p{c}" for c in range(self.k))]
        rows = split.select("row", "label_index", "idx", "tf")
        if self.rare is not None:
            w = F.col("count") * F.col("idf")
            part = (_by("term", _rare(split), self.rare).groupBy("row")
                    .agg(F.sum(w * w).alias("squares"), *(F.sum(w * F.col(f"g{c}")).alias(f"p{c}") for c in range(k))))
            rows = _by("row", rows, part, "left").fillna(0.0, names)
        else:
            rows = rows.select("*", *(F.lit(0.0).alias(x) for x in names))
        sc = counted.sparkSession.sparkContext
        idf, dense, intercept = sc.broadcast(self.dense_idf), sc.broadcast(self.dense), self.intercept

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                (idx, owner), tf = _read(batch.column(2), np.int32), _read(batch.column(3), np.float64)[0]
                w = tf * idf.value[idx]
                norm = np.sqrt(np.bincount(owner, w * w, n) + batch.column(4).to_numpy())
                m = np.stack([(np.bincount(owner, w * dense.value[idx, c], n) + batch.column(5 + c).to_numpy()) / np.where(norm > 0, norm, 1.0) + intercept[c]
                              for c in range(k)], axis=1)
                full = m if k > 1 else np.concatenate([np.zeros_like(m), m], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(full.argmax(axis=1).astype(float))], ["label_index", "prediction"])

        return rows.select("row", "label_index", "idx", "tf", *names).mapInArrow(predict, "label_index double, prediction double")

    def metrics(self, frame: DataFrame) -> DataFrame:
        return metrics_record(self.transform(frame), labels=tuple(self.labels))

    def metrics_counted(self, counted: DataFrame) -> DataFrame:
        return metrics_record(self.transform_counted(counted), labels=tuple(self.labels))


def fit_baseline(train: DataFrame, max_iter: int = 10, label_col: str = "label", dense_terms: int = DENSE_TERMS) -> Baseline:
    """Fit on the rows with a text; no class weights."""
    model = fit_counted(counted_texts(train.na.drop(subset=["text"]), label_col=label_col), None, max_iter, dense_terms)
    model.label_col = label_col
    return model


def fit_counted(counted: DataFrame, drawn: DataFrame | None = None, max_iter: int = 10, dense_terms: int = DENSE_TERMS) -> Baseline:
    """:func:`fit_baseline` on counted texts; with ``drawn`` on the texts of its ``row`` numbers, each as often as it is there."""
    if drawn is None:
        rows = counted.withColumn("m", F.lit(1).cast("long"))
    else:
        times = stored(drawn.groupBy("row").agg(F.count(F.lit(1)).alias("m")), "baseline-draws")
        rows = stored(counted.join(times, "row").select("row", "label", "m", "terms", "counts"), "baseline-drawn")
    found = rows.where("label is not null").groupBy("label").agg(F.sum("m").alias("n")).collect()  # one row per class
    if not found:
        raise ValueError("there is no labelled training row")
    found = sorted(found, key=lambda r: (-r["n"], r["label"]))  # the order of Spark's StringIndexer
    indexer = StringIndexerModel.from_labels([r["label"] for r in found], inputCol="label", outputCol="label_index", handleInvalid="error")
    sizes = [r["n"] for r in found]
    if len(sizes) == 1:
        return Baseline(indexer, None)
    entries = Entries(indexer.transform(rows), len(sizes), sum(sizes), dense_terms)
    try:
        logs = np.array([math.log1p(n) for n in sizes])
        start = logs - logs.mean() if entries.k > 1 else np.array([math.log(sizes[1] / sizes[0])])
        rows = Rows(entries, start)
        search = Search(rows, max_iter)
        point = search.run()
        return Baseline(indexer, entries, entries.gradient(rows.residuals(search.points, point)), start)
    finally:
        entries.close()
