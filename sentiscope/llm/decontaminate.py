"""Operator 4: benchmark decontamination by suffix arrays over the training texts.

Every task builds suffix arrays over shards of its documents' words and
binary-searches every suffix of the benchmark items in them.  A suffix of at least
``window`` words (or a whole shorter item) has its occurrences in one interval of a
shard's array; each occurrence is extended to the longest verbatim match.  Documents
with a match can then be removed.

A shard's array leaves out words that no item has, and runs of known words shorter
than the shortest window: no match can lie there.  The items are searched in blocks
of about ``block_words`` words, so what a task and the driver hold of the benchmark
is bounded however large it grows; each block is one pass over the documents, and
the passes meet in one aggregation by row.  Documents never meet each other.

Defined results: a null or empty text has no words and no match; an item without
words matches nothing; a null item id counts as the empty string; repeated items
count once by id, repeated documents are separate rows; an empty benchmark leaves
all documents clean.  Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import fresh_name, materialise, ship, text_key, text_or_empty

ship(__name__)

WINDOW = 10
BLOCK_WORDS = 1_000_000
SHARD_WORDS = 1_000_000

# Word bytes are 0-9, a-z (A-Z lower-cased) and everything beyond ASCII; others separate.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

MATCHES = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"


def words_of(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if isinstance(text, str) else []


class TestSuffixes:
    """The suffixes of one block of items that have room for their window, as word numbers."""

    def __init__(self, items: pd.DataFrame, window: int):
        self.ids, self.vocabulary = [], {}
        flat, starts, lengths = [], [], []
        for item_id, text in zip(items["item_id"], items["text"], strict=True):
            words = words_of(text)
            if words:
                self.ids.append(item_id)
                starts.append(len(flat))
                lengths.append(len(words))
                flat.extend(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
                flat.append(0)
        self.words = np.array(flat, dtype=np.int64)
        room = [np.arange(max(1, n - window + 1)) for n in lengths]
        self.item = np.repeat(np.arange(len(room)), [len(r) for r in room])
        self.offset = np.concatenate(room) if room else np.zeros(0, dtype=np.int64)
        self.start = np.array(starts, dtype=np.int64)[self.item] + self.offset
        self.width = np.minimum(np.array(lengths, dtype=np.int64), window)[self.item]
        self.longest = max(lengths, default=0)
        self.shortest = int(self.width.min()) if len(self.width) else 0


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, compared over at least ``depth`` words (prefix doubling)."""
    n, k = len(words), 1
    rank = np.unique(words, return_inverse=True)[1]
    while k < depth:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(0, n - k)] = rank[k:] + 1
        kinds, rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)
        k *= 2
        if len(kinds) == n:
            break
    return np.argsort(rank, kind="stable")


def _bound(words: np.ndarray, order: np.ndarray, tests: TestSuffixes, columns: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all test suffixes at once: the first place not before (or after) each one's window."""
    low = np.zeros(len(tests.start), dtype=np.int64)
    high = np.full(len(tests.start), len(order), dtype=np.int64)
    width = len(columns[0])
    within = np.arange(width) < tests.width[:, None]
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = order[np.minimum(middle, len(order) - 1)][:, None] + np.arange(width)
        there = words[np.minimum(at, len(words) - 1)] * (at < len(words))
        differ = (there != columns) & within
        first = differ.argmax(axis=1)
        rows = np.arange(len(first))
        any_ = differ[rows, first]
        less = any_ & (there[rows, first] < columns[rows, first])
        go_up = open_ & (less | ~any_ if after else less)
        low = np.where(go_up, middle + 1, low)
        high = np.where(open_ & ~go_up, middle, high)
    return low


def search(words: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest matches of the test suffixes in ``words`` (0 separates): suffix, place, number of words."""
    none = np.zeros(0, dtype=np.int64)
    if not len(tests.start) or not len(words):
        return none, none, none
    # leave out runs of known words that are too short for any window
    known = np.flatnonzero(words)
    if not len(known):
        return none, none, none
    run = np.cumsum(np.r_[1, np.diff(known) > 1])
    places = known[np.bincount(run)[run] >= tests.shortest]
    if not len(places):
        return none, none, none
    gap = np.r_[False, np.diff(places) > 1]
    at = np.arange(len(places)) + np.cumsum(gap)
    dense = np.zeros(at[-1] + 2, dtype=np.int64)
    dense[at] = words[places]
    back = np.zeros(len(dense), dtype=np.int64)
    back[at] = places

    order = suffix_array(dense, tests.longest)
    width = int(tests.width.max())
    item_at = np.minimum(tests.start[:, None] + np.arange(width), len(tests.words) - 1)
    columns = tests.words[item_at]
    low = _bound(dense, order, tests, columns, after=False)
    high = _bound(dense, order, tests, columns, after=True)
    counts = high - low
    suffix = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(suffix)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = order[low[suffix] + inside]
    # keep those that no longer match contains: the word before differs, or the item starts
    before = dense[np.maximum(place - 1, 0)] * (place > 0)
    begins = tests.offset[suffix] == 0
    new = begins | (before != tests.words[np.maximum(tests.start[suffix] - 1, 0)])
    suffix, place = suffix[new], place[new]
    size = tests.width[suffix].copy()
    grow = np.arange(len(suffix))
    while len(grow):
        item_word = tests.words[np.minimum(tests.start[suffix[grow]] + size[grow], len(tests.words) - 1)]
        doc_at = place[grow] + size[grow]
        doc_word = dense[np.minimum(doc_at, len(dense) - 1)] * (doc_at < len(dense))
        grow = grow[(item_word == doc_word) & (item_word > 0)]
        size[grow] += 1
    return suffix, back[place], size


def _shard_rows(rows: list, tests: TestSuffixes) -> pd.DataFrame:
    """``rows`` holds (row, doc_id, word numbers) of one shard."""
    starts, flat = [], []
    for _, _, numbers in rows:
        starts.append(len(flat))
        flat.extend(numbers)
        flat.append(0)
    suffix, place, size = search(np.array(flat, dtype=np.int64), tests)
    doc = np.searchsorted(np.array(starts), place, side="right") - 1
    found: dict[int, list] = {}
    for d, s, p, n in zip(doc.tolist(), suffix.tolist(), place.tolist(), size.tolist(), strict=True):
        found.setdefault(d, []).append((tests.ids[tests.item[s]], int(tests.offset[s]), p - starts[d], n))
    return pd.DataFrame({"row": [r[0] for r in rows], "doc_id": pd.Series([r[1] for r in rows], dtype=object),
                         "n_words": [len(r[2]) for r in rows], "matches": [found.get(i, []) for i in range(len(rows))]})


def _searcher(tests_on_executors, shard_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tests = SimpleNamespace(**tests_on_executors.value)
        number = tests.vocabulary.get
        for batch in batches:
            rows, held = [], 0
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"], strict=True):
                numbers = list(map(number, words_of(text), repeat(0)))
                rows.append((row, doc_id, numbers))
                held += len(numbers)
                if held >= shard_words:
                    yield _shard_rows(rows, tests)
                    rows, held = [], 0
            if rows:
                yield _shard_rows(rows, tests)

    return run


def _blocks(items: DataFrame, block_words: int) -> Iterator[pd.DataFrame]:
    """The items, about ``block_words`` words at a time."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * block_words)))
    for i in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).toPandas()


def _covered(matches: Column) -> Column:
    """Words of the document inside any match."""
    step = F.aggregate(
        F.sort_array(F.transform(matches, lambda m: F.struct(m.doc_start.alias("a"), (m.doc_start + m.n_words).alias("b")))),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda s, m: F.struct(F.greatest(s.end, m.b).alias("end"),
                              (s.total + F.greatest(m.b - F.greatest(s.end, m.a), F.lit(0))).alias("total")))
    return step.total.cast("long")


def find_passages(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: ``row, doc_id, n_words, n_hit, items, matches``.

    ``items`` are the ids of matched items, sorted; ``matches`` has each longest match
    with its word places in the item and in the document.  ``row`` numbers the input
    rows within this result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    listed = items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("item_id"),
                          F.col(item_text_col).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    passes = [texts.mapInPandas(_searcher(spark.sparkContext.broadcast(vars(TestSuffixes(block, window))), shard_words),
                                f"row long, doc_id {kind}, n_words long, matches {MATCHES}")
              for block in _blocks(listed, block_words)]
    merged = (reduce(DataFrame.unionByName, passes).groupBy("row")
              .agg(F.any_value("doc_id").alias("doc_id"), F.any_value("n_words").alias("n_words"),
                   F.flatten(F.collect_list("matches")).alias("matches")))
    return merged.select("row", "doc_id", "n_words", _covered(F.col("matches")).alias("n_hit"),
                         F.sort_array(F.array_distinct(F.col("matches.item_id"))).alias("items"), "matches")


def remove_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents without a match, with their own columns.

    Whether a document goes depends on its text alone, so digests of the matched texts
    join back; they are stored first, so Spark knows how many there are.
    """
    key = fresh_name(docs, "_key")
    keyed = docs.withColumn(key, text_key(text_or_empty(text_col)))
    found = find_passages(keyed, items, id_col=key, text_col=text_col, **options)
    hit = materialise(found.where(F.col("n_hit") > 0).select(F.col("doc_id").alias(key)).distinct(), "passages")
    return keyed.join(hit, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
