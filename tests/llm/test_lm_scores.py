"""The interpolated model in plain Python: weights, scores and probabilities that sum to 1."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from sentiscope.llm import interpolated_lm as lm

START, END = "\r", "\n"


def _held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


class PlainModel:
    """Counts in dictionaries; every token is visited on its own."""

    def __init__(self, texts):
        self.word, self.context, self.pair = Counter(), Counter(), Counter()
        for text in texts:
            for c, w in self.steps(text):
                self.word[w] += 1
                self.context[c] += 1
                self.pair[c, w] += 1
        self.total, self.uniform = sum(self.word.values()), 1 / (len(self.word) + 1)
        events = Counter()
        for text in texts:
            for c, w in self.steps(text):
                n, two, one = self.context[c] - 1, self.pair[c, w] - 1, self.word[w] - 1
                grid = [round(lm.GRID * math.log2(x / y)) if x else None for x, y in ((two, n), (one, self.total - 1))]
                events[int(math.log2(n + 1)), *grid] += 1
        self.weights = {k: self.em({e: n for e, n in events.items() if k in (-1, e[0])}) for k in {-1} | {e[0] for e in events}}

    @staticmethod
    def steps(text):
        words = [*(text or "").lower().split(), END]
        return list(zip([START, *words], words))

    def em(self, events):
        weights = [1 / 3] * 3
        for _ in range(lm.EM_STEPS):
            gained = [1.0] * 3
            for (_, *grid), n in events.items():
                shares = [w * p for w, p in zip(weights, [*(0.0 if g is None else 2 ** (g / lm.GRID) for g in grid), self.uniform])]
                gained = [g + n * s / sum(shares) for g, s in zip(gained, shares)]
            weights = [g / sum(gained) for g in gained]
        return weights

    def probability(self, context, word):
        n = self.context[context]
        two, one, rest = self.weights.get(int(math.log2(n + 1)), self.weights[-1])
        if n == 0:
            two, one, rest = 0.0, one / (one + rest), rest / (one + rest)
        return two * self.pair[context, word] / max(n, 1) + one * self.word[word] / self.total + rest * self.uniform

    def score(self, text):
        return sum(math.log10(self.probability(c, w)) for c, w in self.steps(text))


def _texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 60)))) for i in range(60)]
    rows += [(None, "w1 w2 w3"), (3, rows[3][1]), (61, None), (62, ""), (63, "Never SEEN words w1"), (64, "w1 " * 3000)]
    out = next(i for i in range(100, 200) if _held_out(i))
    return [*rows, (out, "unseen w1 other unseen w1"), (out, "w5 w6")]


def test_scores_equal_a_plain_model(spark):
    rows = _texts()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, words string").repartition(3)
    plain = PlainModel([t for i, t in rows if not _held_out(i)])
    got = sorted(((r.doc_id, r.n_tokens, r.score) for r in
                  lm.score_documents(docs, chunk_tokens=300, range_tokens=500).collect()), key=str)
    want = sorted(((i, len(plain.steps(t)), plain.score(t)) for i, t in rows), key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[1], r[2])), sorted(want, key=lambda r: (str(r[0]), r[1], r[2]))):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-6)


def test_every_context_sums_to_one():
    plain = PlainModel([t for i, t in _texts() if not _held_out(i)])
    for context in [START, "w1", "w39", "no such context"]:
        known = sum(plain.probability(context, w) for w in plain.word)
        assert math.isclose(known + plain.probability(context, "no such word"), 1.0, rel_tol=1e-9)
    table = lm._weight_table({-1: (0.5, 0.3, 0.2)})
    assert np.allclose(table.sum(axis=1), 1.0) and table[0, 0] == 0.0 and math.isclose(table[0, 1], 0.6)
