"""Operator 7: language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of bigrams, unigrams and the uniform
distribution.  The mixture weights depend on how often the context was seen (one set per
power of two) and are learned by expectation-maximisation on the training documents, each
token with itself deleted from the counts; held-out documents are scored and nothing else.  After a context that
was never seen the unigram and uniform shares are scaled to 1, so every context's probabilities sum to 1.

Counting and scoring without a row per token in any shuffle:

1. documents are packed into chunks of about ``chunk_tokens`` words, training and held-out
   apart, written once to the shared folder;
2. every chunk sends its distinct n-gram hashes, sorted and cut by hash range, with their
   counts; a range's task sums the training counts and answers each chunk with the totals of
   the n-grams it asked for, in its order.  The number of ranges grows with the corpus, so
   a task's load does not; a frequent word is one entry per chunk, never a hot key;
3. training chunks meet their answers, less the token itself, and count events by context class and the two
   estimates on a logarithmic grid; the EM steps run on that table, whose size is bounded by
   the grid, not by the corpus;
4. all chunks meet their answers and score their documents.

Defined results: a null or empty text is the end token alone; a null id is training data;
repeated rows count and score each; an empty table gives no rows.  Only the named columns
are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import materialise, ship

ship(__name__)

CHUNK_TOKENS = 1_000_000
RANGE_TOKENS = 4_000_000
EM_STEPS = 30
GRID = 8  # steps of the logarithmic grid per octave
NEVER = -10_000
END, START = pd.util.hash_array(np.array([b"\n", b"\r"], dtype=object), categorize=False)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _tokens(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


def _packer(chunk_tokens: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made = TaskContext.get().partitionId(), 0
        held: dict[bool, tuple[list, list, list]] = {True: ([], [], []), False: ([], [], [])}
        size = {True: 0, False: 0}

        def row(which: bool) -> pd.DataFrame:
            nonlocal made
            ids, lengths, lines = held[which]
            made += 1
            packed = zlib.compress(b"\n".join(lines), 1)
            held[which], size[which] = ([], [], []), 0
            return pd.DataFrame({"chunk": [f"{part}-{made}"], "held_out": [which], "ids": [ids], "lengths": [lengths],
                                 "tokens": [sum(lengths)], "words": [packed]})

        for batch in batches:
            for doc_id, out, text in zip(batch["doc_id"].tolist(), batch["held_out"], batch["text"], strict=True):
                words = _tokens(text)
                ids, lengths, lines = held[bool(out)]
                ids.append(doc_id)
                lengths.append(len(words) + 1)
                lines.append(b" ".join(words))
                size[bool(out)] += lengths[-1]
                if size[bool(out)] >= chunk_tokens:
                    yield row(bool(out))
        for which in (True, False):
            if held[which][0]:
                yield row(which)

    return run


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk's tokens: word hash, context hash (the word before, or the start), bigram hash."""
    flat = zlib.decompress(words).replace(b"\n", b" \n ").split(b" ")
    flat = [w for w in flat if w]
    flat.append(b"\n")
    word = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    context = np.r_[START, word[:-1]].astype(np.uint64)
    context[context == END] = START
    return word, context, _mix(_mix(context) * np.uint64(3) + word)


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Range number of sorted 64-bit keys; it never falls."""
    return np.minimum((keys.astype(np.float64) / 2.0**64 * ranges).astype(np.int64), ranges - 1)


def _asker(ranges: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, held_out, words in zip(batch["chunk"], batch["held_out"], batch["words"], strict=True):
                word, _, pair = _hashes(words)
                rows = []
                for order, hashes in ((1, word), (2, pair)):
                    keys, counts = np.unique(hashes, return_counts=True)
                    cuts = np.searchsorted(_ranges(keys, ranges), np.arange(ranges + 1))
                    for r in np.flatnonzero(np.diff(cuts)):
                        part = slice(cuts[r], cuts[r + 1])
                        rows.append((int(r), order, chunk, bool(held_out), keys[part].tobytes(),
                                     zlib.compress(counts[part].astype(np.uint32).tobytes(), 1)))
                yield pd.DataFrame(rows, columns=["range", "order", "chunk", "held_out", "keys", "counts"])

    return run


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Training totals of one range and order, for every chunk that asked."""
    asked = [np.frombuffer(k, dtype=np.uint64) for k in group["keys"]]
    train = ~group["held_out"].to_numpy(dtype=bool)
    counts = [np.frombuffer(zlib.decompress(c), dtype=np.uint32) for c, t in zip(group["counts"], train, strict=True) if t]
    seen = [k for k, t in zip(asked, train, strict=True) if t]
    keys, at = np.unique(np.concatenate(seen) if seen else np.zeros(0, dtype=np.uint64), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64) if seen else np.zeros(0, np.int64)
    answers = []
    for wanted in asked:
        place = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        found = np.where(keys[place] == wanted, totals[place], 0) if len(keys) else np.zeros(len(wanted), np.int64)
        answers.append(zlib.compress(found.astype(np.int64).tobytes(), 1))
    order = int(group["order"].iloc[0])
    return pd.DataFrame({"chunk": group["chunk"], "order": order, "range": group["range"], "totals": answers,
                         "distinct": [len(keys) if order == 1 and i == 0 else 0 for i in range(len(group))]})


def _estimates(words: bytes, answers: pd.DataFrame):
    """Per token of a chunk: training counts of the word, of the context and of the bigram."""
    word, context, pair = _hashes(words)
    answers = answers.sort_values(["order", "range"])

    def totals(order: int, hashes: np.ndarray):
        keys, at = np.unique(hashes, return_inverse=True)
        parts = [np.frombuffer(zlib.decompress(t), dtype=np.int64) for t in answers.loc[answers["order"] == order, "totals"]]
        return keys, np.concatenate(parts), at

    keys, of_word, at = totals(1, word)
    _, of_pair, at_pair = totals(2, pair)
    # the start comes as often as the end; every other context is a word of the chunk
    as_word = np.where(context == START, END, context)
    return of_word[at], of_word[np.searchsorted(keys, as_word)], of_pair[at_pair]


def _classes(context: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(context + 1.0)).astype(np.int64)


def _event_counter(total: int):
    def run(key, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if chunk.empty:
            return pd.DataFrame({"cls": [], "two": [], "one": [], "n": []})
        word, context, pair = (n - 1 for n in _estimates(chunk["words"].iloc[0], answers))  # without the token itself
        with np.errstate(divide="ignore", invalid="ignore"):
            two = np.where(pair > 0, np.rint(GRID * np.log2(pair / np.maximum(context, 1))), NEVER)
            one = np.where(word > 0, np.rint(GRID * np.log2(word / max(total - 1, 1))), NEVER)
        events = pd.DataFrame({"cls": _classes(context), "two": two.astype(np.int64), "one": one.astype(np.int64)})
        return events.value_counts().rename("n").reset_index()

    return run


def learn_weights(events: pd.DataFrame, uniform: float, steps: int = EM_STEPS) -> dict[int, tuple[float, float, float]]:
    """Mixture weights (bigram, unigram, uniform) per context class; class -1 holds those for classes without events."""
    def em(part: pd.DataFrame) -> tuple[float, float, float]:
        n = part["n"].to_numpy(dtype=np.float64)
        p = np.stack([np.where(part[c] > NEVER, np.exp2(part[c] / GRID), 0.0) for c in ("two", "one")]
                     + [np.full(len(part), uniform)])
        weights = np.full(3, 1 / 3)
        for _ in range(steps):
            shares = weights[:, None] * p
            gained = (shares / shares.sum(axis=0) * n).sum(axis=1) + 1.0  # one event each keeps all weights positive
            weights = gained / gained.sum()
        return tuple(weights)

    if events.empty:
        return {-1: (1 / 3, 1 / 3, 1 / 3)}
    return {int(c): em(part) for c, part in events.groupby("cls")} | {-1: em(events)}


def _weight_table(weights: dict[int, tuple[float, float, float]]) -> np.ndarray:
    """Weights by context class.  A context never seen (class 0) has no bigrams: the other two share the whole."""
    table = np.array([weights.get(c, weights[-1]) for c in range(65)])
    table[0, 0] = 0.0
    table[0] /= table[0].sum()
    return table


def _scorer(total: int, distinct: int, weights: dict):
    table = _weight_table(weights)

    def run(key, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if chunk.empty:
            return pd.DataFrame({c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})
        word, context, pair = _estimates(chunk["words"].iloc[0], answers)
        base = np.log10((word + 0.1) / (total + 0.1 * (distinct + 1)))
        mix = table[_classes(context)]
        score = np.log10(mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word / max(total, 1) + mix[:, 2] / (distinct + 1))
        lengths = np.asarray(chunk["lengths"].iloc[0], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        return pd.DataFrame({
            "doc_id": pd.Series(list(chunk["ids"].iloc[0]), dtype=object), "held_out": bool(chunk["held_out"].iloc[0]),
            "n_tokens": lengths, "n_known": np.add.reduceat((word > 0).astype(np.int64), starts), "train_tokens": total,
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(score, starts)})

    return run


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
                    chunk_tokens: int = CHUNK_TOKENS, range_tokens: int = RANGE_TOKENS, steps: int = EM_STEPS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    apart = is_held_out(F.col(id_col)) if held_out is None else F.coalesce(held_out, F.lit(False))
    texts = docs.select(F.col(id_col).alias("doc_id"), apart.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    chunks = materialise(texts.mapInPandas(
        _packer(chunk_tokens), f"chunk string, held_out boolean, ids array<{kind}>, lengths array<int>, tokens long, words binary"),
        "chunks")
    counted = chunks.agg(F.sum("tokens"), F.sum(F.when(~F.col("held_out"), F.col("tokens")))).first()
    everything, total = counted[0] or 0, counted[1] or 0
    ranges = max(1, -(-everything // range_tokens))
    asked = chunks.select("chunk", "held_out", "words").mapInPandas(
        _asker(ranges), "range int, order int, chunk string, held_out boolean, keys binary, counts binary")
    answers = materialise(asked.groupBy("range", "order").applyInPandas(
        _answer, "chunk string, order int, range int, totals binary, distinct long"), "answers")
    distinct = answers.agg(F.sum("distinct")).first()[0] or 0
    replies = answers.select("chunk", "order", "range", "totals")

    seen = chunks.where(~F.col("held_out")).select("chunk", "words")
    mine = replies.join(seen.select("chunk"), "chunk", "left_semi")
    events = (seen.groupBy("chunk").cogroup(mine.groupBy("chunk"))
              .applyInPandas(_event_counter(total), "cls long, two long, one long, n long")
              .groupBy("cls", "two", "one").agg(F.sum("n").alias("n"))).toPandas()
    weights = learn_weights(events, 1 / (distinct + 1), steps)
    return (chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(
        _scorer(total, distinct, weights),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))

