"""Operator 11: spelling variants by Bloom-guided neighbourhoods.

Every vocabulary word generates its edits (one letter deleted, one letter replaced); the
edits are probed against blocked Bloom filters of the vocabulary, sharded by word length,
that are broadcast in groups of a fixed size bound.  Only the positives become strings and
are shuffled to an exact join with the vocabulary, which removes the false positives.  A
word's inserted letter is the other word's deleted one, and a replacement is generated by
the smaller of the two words only, so each near pair is found once and then mirrored.

The hash of an edit is computed from prefix and suffix sums of a polynomial hash, so no
edit is built before its filter says yes.  All state in a task is one chunk of probes and
one group of filters (``BROADCAST_BYTES``); a vocabulary whose filters are larger is probed in
several passes, which changes no result.

Defined cases: null words and texts count nothing; a null document id reads as ``null``; ties of
the largest count go to the smallest word in code-point order; an empty table gives no rows;
other columns of the input are ignored; words may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import materialise, ship

# Fixed values of the contract.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOISE_STEP = 199
MIN_LENGTH, MIN_COUNT, FORM_RATIO = 6, 5, 5

LONG = 64                      # words of this many letters or more share one length class
SLICE_WORDS = 1 << 19          # expected words of a filter slice
BITS_PER_WORD = 16
PROBES = 7                     # bits that a word sets in its block of 512
BROADCAST_BYTES = 64 << 20     # filters broadcast at once
CHUNK = 1 << 21                # probes held in memory at once

_PRIME = 0x9E3779B97F4A7C15    # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)


# ------------------------------------------------------------------ counting
def word_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, run``: every maximal letter run of every whole text, A-Z lower-cased."""
    lower = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    return docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("doc"),
                       F.explode(F.regexp_extract_all(lower, F.lit(f"({RUN})"), 1)).alias("run"))


def with_slips(runs: DataFrame, step: int = NOISE_STEP) -> DataFrame:
    """``word``: the run, or, where ``step`` divides the crc32 of ``doc:run``, the run without one letter."""
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    place = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + F.lit(2), F.length("run")))
    return (runs.select("run", h.alias("h"))
            .select(F.when(F.col("h") % step == 0, cut).otherwise(F.col("run")).alias("word")))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough (partial counts before the shuffle)."""
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


# ------------------------------------------------------------------- hashing
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    """``_PRIME ** i`` for i below n, modulo 2**64."""
    steps = np.full(n, _PRIME, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one row per word, each plus 1."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return flat.reshape(len(words), -1) + np.uint64(1)


def _keys(total: np.ndarray, length: int) -> np.ndarray:
    return _mix(total + np.uint64((length * 0xD6E8FEB86659FD93) & (2**64 - 1)))


def _length_class(length: int) -> int:
    return min(length, LONG)


class _Filter:
    """Blocked Bloom filters of one length class, one per slice."""

    def __init__(self, slices: int, blocks: int, bits: dict[int, bytes] | None = None):
        self.slices, self.blocks = slices, blocks
        self.bits = {s: np.frombuffer(b, np.uint8) for s, b in (bits or {}).items()}

    def places(self, keys: np.ndarray):
        """Slice, first bit of the block, and the packed places in the block."""
        part = (keys >> np.uint64(44)) % np.uint64(self.slices)
        start = (keys & np.uint64(self.blocks - 1)) << np.uint64(9)
        return part, start, _mix(keys ^ np.uint64(0xA0761D6478BD642F))

    def build(self, keys: np.ndarray) -> bytes:
        """The filter of one slice."""
        bits = np.zeros(self.blocks * 64, np.uint8)
        _, start, places = self.places(keys)
        for i in range(PROBES):
            at = start + ((places >> np.uint64(9 * i)) & np.uint64(511))
            np.bitwise_or.at(bits, at >> np.uint64(3), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
        return bits.tobytes()

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that the slices at hand may contain."""
        part, start, places = self.places(keys)
        found = []
        for s, bits in self.bits.items():
            at = np.flatnonzero(part == np.uint64(s)) if self.slices > 1 else np.arange(len(keys))
            for i in range(PROBES):
                bit = start[at] + ((places[at] >> np.uint64(9 * i)) & np.uint64(511))
                at = at[(bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            found.append(at)
        return np.concatenate(found) if found else np.empty(0, np.int64)


# ------------------------------------------------------------------- filters
def _shards(vocab: DataFrame) -> dict[int, tuple[int, int]]:
    """Length class -> (slices, blocks of a slice); at most ``LONG`` classes."""
    sizes = vocab.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("class")).count().collect()
    out = {}
    for row in sizes:
        slices = -(-row["count"] // SLICE_WORDS)
        wanted = row["count"] / slices * BITS_PER_WORD / 512
        out[row["class"]] = (slices, 1 << max(0, int(np.ceil(np.log2(max(wanted, 1))))))
    return out


def _build_filters(vocab: DataFrame, shards: dict[int, tuple[int, int]]) -> DataFrame:
    """``class, slice, bits``: one row per slice, each built in a task of its own from about ``SLICE_WORDS`` words."""
    def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for length, group in pdf.groupby(pdf["word"].str.len()):
                keys = _word_keys(group["word"].tolist(), int(length))
                c = _length_class(int(length))
                part, _, _ = _Filter(*shards[c]).places(keys)
                yield pd.DataFrame({"class": c, "slice": part.astype(np.int64), "key": keys.view(np.int64)})

    def build(group: pd.DataFrame) -> pd.DataFrame:
        c = int(group["class"].iloc[0])
        bits = _Filter(*shards[c]).build(group["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"class": [c], "slice": [int(group["slice"].iloc[0])], "bits": [bits]})

    ship(__name__)
    keys = vocab.select("word").mapInPandas(sliced, "class int, slice long, key long")
    return keys.groupBy("class", "slice").applyInPandas(build, "class int, slice long, bits binary")


def _word_keys(words: list[str], length: int) -> np.ndarray:
    """Keys of words of one length, in chunks of bounded size."""
    step = max(1, CHUNK // max(length, 1))
    powers = _powers(length)
    parts = [_keys((_codes(words[i:i + step]) * powers).sum(axis=1, dtype=np.uint64), length)
             for i in range(0, len(words), step)]
    return np.concatenate(parts)


# -------------------------------------------------------------------- probes
def _probe(words: list[str], length: int, alphabet: np.ndarray, filters: dict[int, _Filter]):
    """``(word number, edit)`` of the generated edits that the filters may contain."""
    powers = _powers(length)
    same, shorter = filters.get(_length_class(length)), filters.get(_length_class(length - 1))
    letters = alphabet + np.uint64(1)
    per_word = length * (len(letters) if same else 1)
    step = max(1, CHUNK // per_word)
    for first in range(0, len(words), step):
        codes = _codes(words[first:first + step])
        terms = codes * powers
        total = terms.sum(axis=1, dtype=np.uint64)
        if shorter and length > 1:
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            after = (total[:, None] - before - terms) * np.uint64(_INVERSE)
            new = np.ones(codes.shape, bool)  # of equal neighbours only the first is deleted
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            row, at = np.nonzero(new)
            for hit in shorter.hits(_keys((before + after)[row, at], length - 1)):
                w, i = words[first + row[hit]], int(at[hit])
                yield first + int(row[hit]), w[:i] + w[i + 1:]
        if same:
            span = max(1, CHUNK // (len(codes) * len(letters)))  # positions at once, for very long words
            for lo in range(0, length, span):
                old = codes[:, lo:lo + span, None]
                row, at, letter = np.nonzero(letters[None, None, :] > old)
                changed = total[row] + (letters[letter] - codes[row, lo + at]) * powers[lo + at]
                for hit in same.hits(_keys(changed, length)):
                    w, i = words[first + row[hit]], lo + int(at[hit])
                    yield first + int(row[hit]), w[:i] + chr(int(alphabet[letter[hit]])) + w[i + 1:]


def _candidates(vocab: DataFrame, alphabet: list[int], shards: dict, bits: DataFrame) -> DataFrame:
    """``word, n, edit`` of all positives, one pass per group of filters within ``BROADCAST_BYTES``."""
    groups: list[list[tuple[int, int]]] = [[]]
    room = BROADCAST_BYTES
    for c, (slices, blocks) in sorted(shards.items()):
        for s in range(slices):
            if blocks * 64 > room and groups[-1]:
                groups.append([])
                room = BROADCAST_BYTES
            groups[-1].append((c, s))
            room -= blocks * 64
    spark, letters = vocab.sparkSession, np.array(sorted(alphabet), np.uint64)
    found = None
    for group in groups:
        ranges = {}  # class -> its slices of this group, consecutive numbers
        for c, s in group:
            ranges.setdefault(c, []).append(s)
        wanted = F.lit(False)
        for c, s in ranges.items():
            wanted |= (F.col("class") == c) & F.col("slice").between(s[0], s[-1])
        held = {c: {} for c in ranges}
        for row in bits.where(wanted).collect():  # at most BROADCAST_BYTES
            held[row["class"]][row["slice"]] = bytes(row["bits"])
        shared = spark.sparkContext.broadcast({c: (*shards[c], held[c]) for c in ranges})

        def probe(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            filters = {c: _Filter(*parts) for c, parts in shared.value.items()}
            for pdf in batches:
                for length, part in pdf.groupby(pdf["word"].str.len()):
                    words, counts, held = part["word"].tolist(), part["n"].to_numpy(), []
                    size = 0
                    for i, edit in _probe(words, int(length), letters, filters):
                        held.append((words[i], counts[i], edit))
                        size += 2 * int(length)
                        if size > CHUNK:
                            yield pd.DataFrame(held, columns=["word", "n", "edit"])
                            held, size = [], 0
                    if held:
                        yield pd.DataFrame(held, columns=["word", "n", "edit"])

        classes = sorted({x for c in ranges for x in (c, c + 1)})
        asked = vocab.where(F.least(F.length("word"), F.lit(LONG)).isin(classes))
        ship(__name__)
        # written before the broadcast goes, so one group at a time is held
        passed = materialise(asked.mapInPandas(probe, "word string, n long, edit string"), "spelling-positives")
        shared.unpersist()
        found = passed if found is None else found.unionByName(passed)
    return found


# ------------------------------------------------------------------ operator
def near_pairs(vocab: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all pairs of words at one edit, both ways round; ``vocab`` is a stored table."""
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
    alphabet = [ord(r["c"]) for r in letters.where("c != ''").collect()]  # bounded by the script's letters
    shards = _shards(vocab)
    if not shards:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    bits = materialise(_build_filters(vocab, shards), "spelling-filters")
    positives = _candidates(vocab, alphabet, shards, bits)
    known = vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    both = F.array(F.struct("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")),
                   F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"),
                            F.col("n").alias("near_n")))
    return positives.join(known, "edit").select(F.inline(both))


def spelling_forms(vocab: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per vocabulary word.

    ``form``: the near word of largest count, if that is at least ``ratio`` (above 1) times the word's; ``root``:
    where the forms lead.  Counts grow along the forms, so there is no circle, and
    doubling the steps ends after the binary logarithm of the longest chain.
    """
    vocab = materialise(vocab.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")),
                        "spelling-vocabulary")
    best = (near_pairs(vocab).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("b")))
    judged = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.minus") >= ratio * F.col("n"), F.struct(F.col("b.near").alias("form"), (-F.col("b.minus")).alias("form_n"))).alias("f"))
    judged = materialise(judged.select("word", "n", "n_near", "f.form", "f.form_n"), "spelling-forms")
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(step, "root", "left")
                            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                            "spelling-roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return judged.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _crc_table() -> list[int]:
    """The 256 remainders of the reflected polynomial of crc32."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


# DuckDB has no crc32: it is computed from the bytes (all letters are below U+0100).
SPELLING_SQL = f"""
WITH RECURSIVE tbl AS (SELECT {_crc_table()}::BIGINT[] AS t),
runs AS (
  SELECT COALESCE(CAST(doc_id AS VARCHAR), 'null') AS doc, r AS run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS r
    FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(list_reduce(
    flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
      ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM runs, tbl),
words AS (
  SELECT CASE WHEN h % {NOISE_STEP} = 0
              THEN substring(run, 1, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2)
              ELSE run END AS word, k FROM hashed),
voc AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM words WHERE length(word) >= {MIN_LENGTH} GROUP BY word
  HAVING sum(k) >= {MIN_COUNT}),
cuts AS MATERIALIZED (
  SELECT DISTINCT word, n, p, substring(word, 1, p - 1) AS a, substring(word, p + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM voc)),
near AS (
  SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y ON x.p = y.p AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, x.n, v.word, v.n FROM cuts x JOIN voc v ON v.word = x.a || x.b
  UNION SELECT v.word, v.n, x.word, x.n FROM cuts x JOIN voc v ON v.word = x.a || x.b),
best AS (
  SELECT word, any_value(n) AS n, count(*) AS n_near, max(near_n) AS top, first(near ORDER BY near_n DESC, encode(near)) AS near
  FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT v.word, v.n, COALESCE(b.n_near, 0) AS n_near, CASE WHEN b.top >= {FORM_RATIO} * v.n THEN b.near END AS form,
         CASE WHEN b.top >= {FORM_RATIO} * v.n THEN b.top END AS form_n
  FROM voc v LEFT JOIN best b ON b.word = v.word),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, e.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN ends e ON e.word = f.word
"""
