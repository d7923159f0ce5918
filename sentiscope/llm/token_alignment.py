"""Operator 13: token alignment of two tokenizers by divide and conquer at shared cuts.

Both token sequences of a text cover the same bytes.  An interval of both sequences is split at an
end that they share: the end of the first sequence's middle token is looked up among the
second's ends by bisection, then the ends around it in widening windows, and both halves go on in the same way; an
interval without a shared end inside is a leaf group.  All intervals of one depth, over all texts of
a batch, take their steps together as array operations, so the depth is the logarithm of the longest text.

A text is tokenised by its stretches, which begin at single spaces that no token of either vocabulary can cross
(``_stretch_starts``); a stretch that a task meets again takes the tokens it had (``_Stretches``, bounded by
``HELD_BYTES``).  With tokenizers that are not known to read stretches apart, whole texts are tokenised.

``align_documents`` gives the ids and the groups.  ``link_scores`` counts how often an id pair is linked (ends at
the same byte) in the whole corpus and scores each document by it.  Links are numbered within
blocks of documents: only a block's distinct pairs with their counts are shuffled to the corpus
count, so the rows of a frequent pair are the number of blocks, and each block
gets back the counts of its own pairs alone.  A task holds one block (``BLOCK_LINKS``, or one longer document).

Defined cases: null and empty texts, and texts whose tokens do not spell space+text in both tokenizers, have no
tokens (zeros, empty digest); null and repeated ids are kept row by row; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sentiscope.llm.common import materialise, ship

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE_BYTES = 1 << 19      # bytes of text tokenised at once (or one longer text)
BLOCK_LINKS = 1 << 21      # links of a block
HELD_BYTES = 1 << 22       # bytes of the stretches whose tokens a task keeps (and those of one piece)
SHIFT = 32                 # a pair is first id << SHIFT | second id
WIDEN = 8                  # growth of the search window around a middle

ALIGNED = "array<int>"
IDS = ("a_ids", "b_ids", "a_sizes", "b_sizes")
_LOADED: dict = {}


# ---------------------------------------------------------------- tokenizers
def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable ones stand for themselves, the others follow from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Byte-level vocabulary of the ``tokenizers`` library; a text is read with a space before it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        steps = json.loads(self._tokenizer.to_str())
        # letters for all bytes, nothing added, nothing normalised: whatever it reads, it spells
        self.lossless = (steps["normalizer"] is None and steps["pre_tokenizer"]["type"] == "ByteLevel"
                         and not steps["pre_tokenizer"]["add_prefix_space"] and set(letters) <= set(vocabulary)
                         and not any(steps["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")))
        # its pattern begins a word at a space before a character that is none, and the only added tokens are special
        self.reads_stretches = (self.lossless and steps["pre_tokenizer"].get("use_regex") is True and steps["truncation"] is None
                                and steps["padding"] is None and all(t["special"] for t in steps["added_tokens"]))

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class PieceBpe:
    """``sentencepiece`` model with byte fallback; it puts the space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.tokens = [bytes([int(p[3:-1], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(pieces)]
        # nothing normalised, and no piece has a space behind another character: no merge crosses the start of a stretch
        model = _fields(self._model.serialized_model_proto())
        trainer, normalizer = _fields(model.get(2, b"")), _fields(model.get(3, b""))
        self.reads_stretches = (trainer.get(3) == BPE_MODEL and not trainer.get(24) and not normalizer.get(2) and normalizer.get(3, 1) == 1
                                and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
                                and "▁" in pieces and not any("▁" in p.lstrip("▁") for p in pieces))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


BPE_MODEL = 2  # of a sentencepiece model's ``trainer_spec.model_type``


def _fields(message: bytes) -> dict[int, int | bytes]:
    """The last value of every field of a protocol buffer message (a sentencepiece model's settings)."""
    at, out = 0, {}

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = message[at], at + 1
            value, shift = value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            out[key >> 3] = number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            out[key >> 3], at = message[at:at + size], at + size
    return out


def _load(folder: str, name: str):
    """One tokenizer per worker and file."""
    key = f"{folder}/{name}"
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(key) if name.endswith(".json") else PieceBpe(key)
    return _LOADED[key]


# ------------------------------------------------------------------ alignment
def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + size - 1``, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


class _Strings:
    """Byte strings by number, laid out for array look-ups."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._flat = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        """The bytes of the numbered strings, one after another."""
        return self._flat[_ranges(self._starts[numbers], self.sizes[numbers])]


def _split(a_ends: np.ndarray, b_ends: np.ndarray, lo: np.ndarray, last: np.ndarray):
    """A shared end inside each interval ``lo .. last`` of first tokens, near its middle: ``(token of a, token of b)``; -1 if none.

    Ends inside are those of the tokens before ``last``.
    """
    middle = (lo + last - 1) >> 1
    at = np.searchsorted(b_ends, a_ends[middle])  # bisection; an end inside is below the last one
    hit = b_ends[at] == a_ends[middle]
    a_cut, b_cut = np.where(hit, middle, -1), np.where(hit, at, -1)
    open_, width = np.flatnonzero(~hit), 1
    while len(open_):
        first = np.maximum(lo[open_], middle[open_] - width)
        after = np.minimum(last[open_], middle[open_] + width + 1)
        sizes = after - first
        tried = _ranges(first, sizes)
        owner = np.repeat(np.arange(len(open_)), sizes)
        at = np.searchsorted(b_ends, a_ends[tried])
        hit = np.flatnonzero(b_ends[at] == a_ends[tried])
        distance = np.abs(tried[hit] - middle[open_][owner[hit]])
        hit = hit[np.lexsort((tried[hit], distance, owner[hit]))]
        who, best = np.unique(owner[hit], return_index=True)
        a_cut[open_[who]], b_cut[open_[who]] = tried[hit[best]], at[hit[best]]
        whole = (first == lo[open_]) & (after == last[open_])
        whole[who] = True
        open_, width = open_[~whole], width * WIDEN
    return a_cut, b_cut


def _halves(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Left and right halves in the order of the text, so that the next bisections run forward."""
    return np.stack([left, right], axis=1).ravel()


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_last: np.ndarray, b_last: np.ndarray):
    """Tokens of both sequences that end at the same byte, in order.

    ``a_last`` and ``b_last`` are the last tokens of the texts that lie one after another in the
    sequences, each ending at the same byte in both.
    """
    cut_at = np.full(len(a_ends), -1)  # token of b that ends with the token of a
    cut_at[a_last] = b_last
    a_lo, b_lo = np.concatenate([[0], a_last[:-1] + 1]), np.concatenate([[0], b_last[:-1] + 1])
    a_hi, b_hi = a_last, b_last
    while len(a_lo):
        some = np.flatnonzero((a_hi > a_lo) & (b_hi > b_lo))  # a single token has no end inside
        a_lo, a_hi, b_lo, b_hi = a_lo[some], a_hi[some], b_lo[some], b_hi[some]
        a_cut, b_cut = _split(a_ends, b_ends, a_lo, a_hi)
        found = np.flatnonzero(a_cut >= 0)  # the others are leaf groups
        a_cut, b_cut = a_cut[found], b_cut[found]
        cut_at[a_cut] = b_cut
        a_lo, a_hi = _halves(a_lo[found], a_cut + 1), _halves(a_cut, a_hi[found])
        b_lo, b_hi = _halves(b_lo[found], b_cut + 1), _halves(b_cut, b_hi[found])
    a = np.flatnonzero(cut_at >= 0)
    return a, cut_at[a]


# whether a byte after a space can begin white space (or is a control character)
_BLANK = np.isin(np.arange(256), [*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3])


def _stretch_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the stretches of texts begin: at the text's start and at every single space before a character that is no white space.

    The byte-level pattern begins a word there whatever comes before: white space that ends with it leaves its last
    space to the word.  ``starts`` are the starts of the texts, which have a space put before them.
    """
    begins = data == 0x20
    begins[1:] &= data[:-1] != 0x20
    begins[:-1] &= ~_BLANK[data[1:]]
    begins[-1] = False
    begins[starts] = True
    return np.flatnonzero(begins)


class _Tokens:
    """Ids of numbered strings, laid out for array look-ups."""

    def __init__(self):
        self.flat, self.sizes, self.starts = (np.empty(0, kind) for kind in (np.int32, np.int64, np.int64))

    def add(self, ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum()))
        self.flat, self.sizes, self.starts = (
            np.concatenate(x) for x in ((self.flat, flat), (self.sizes, sizes), (self.starts, starts)))

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[_ranges(self.starts[numbers], self.sizes[numbers])]


class _Stretches:
    """Tokens of the stretches met so far, by both tokenizers."""

    def __init__(self, first, second):
        self.sides = first, second
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.held = {}, 0
        self.tokens, self.right = (_Tokens(), _Tokens()), np.empty(0, bool)

    def _add(self, stretches: list[bytes]) -> None:
        self.numbers.update(zip(stretches, range(len(self.numbers), len(self.numbers) + len(stretches))))
        self.held += sum(map(len, stretches))
        texts, right = [s[1:].decode() for s in stretches], np.ones(len(stretches), bool)
        for side, tokens in zip(self.sides, self.tokens):
            ids = side.encode(texts)
            right &= _spells(side, ids, stretches)
            tokens.add(ids)
        self.right = np.concatenate([self.right, right])

    def encode(self, spelt: list[bytes]):
        """Per side ``(ids, number of ids per text)`` of the texts one after another, and which texts their tokens spell."""
        sizes = np.fromiter(map(len, spelt), np.int64, len(spelt))
        starts, data = np.cumsum(sizes) - sizes, b"".join(spelt)
        begins = _stretch_starts(np.frombuffer(data, np.uint8), starts)
        ends = pa.array(np.append(begins, len(data)), pa.int64())
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, ends.buffers()[1], pa.py_buffer(data)]).dictionary_encode()
        found = coded.dictionary.to_pylist()
        if self.held > HELD_BYTES:
            self._forget()
        new = [s for s in found if s not in self.numbers]
        if new:
            self._add(new)
        numbers = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))[coded.indices.to_numpy()]
        text_at = np.searchsorted(begins, starts)
        sides = [(t.joined(numbers), np.add.reduceat(t.sizes[numbers], text_at)) for t in self.tokens]
        return sides, np.logical_and.reduceat(self.right[numbers], text_at)


def _encode(read: list[str], first, second, held: _Stretches | None):
    """``_Stretches.encode`` of texts, by their stretches if ``held`` is given, else whole."""
    spelt = [f" {t}".encode() for t in read]
    if held is not None:
        return held.encode(spelt)
    sides, right = [], np.ones(len(read), bool)
    for side in (first, second):
        ids = side.encode(read)
        right &= _spells(side, ids, spelt)
        tokens = _Tokens()
        tokens.add(ids)
        sides.append((tokens.flat, tokens.sizes))
    return sides, right


def _stretches(first, second) -> _Stretches | None:
    """A store of stretches if both tokenizers read these apart."""
    return _Stretches(first, second) if all(getattr(t, "reads_stretches", False) for t in (first, second)) else None


def align_texts(texts: list[str | None], first, second, held: _Stretches | None = None):
    """Per text ``(a ids, b ids, a tokens per group, b tokens per group)`` as arrays; all empty for a text without tokens."""
    none = np.empty(0, np.int32)
    out = [(none,) * 4 for _ in texts]
    some = [i for i, t in enumerate(texts) if t]
    if not some:
        return out
    sides, right = _encode([texts[i] for i in some], first, second, held)
    kept = [i for i, ok in zip(some, right.tolist()) if ok]
    if not kept:
        return out
    if len(kept) < len(some):
        sides = [(flat[np.repeat(right, counts)], counts[right]) for flat, counts in sides]
    flat, lasts = [f for f, _ in sides], [np.cumsum(counts) - 1 for _, counts in sides]
    ends = [np.cumsum(_strings(side).sizes[f]) for side, f in zip((first, second), flat)]
    a, b = shared_cuts(*ends, *lasts)
    group_end = np.searchsorted(a, lasts[0]) + 1  # groups up to each text's end
    a_sizes, b_sizes = np.diff(a, prepend=-1).astype(np.int32), np.diff(b, prepend=-1).astype(np.int32)
    parts = [np.split(f, last[:-1] + 1) for f, last in zip(flat, lasts)]
    start = 0
    for k, i in enumerate(kept):
        out[i] = (parts[0][k], parts[1][k], a_sizes[start:group_end[k]], b_sizes[start:group_end[k]])
        start = group_end[k]
    return out


def _strings(tokenizer) -> _Strings:
    if len(getattr(tokenizer, "strings", ((),))[0]) != len(tokenizer.tokens):
        tokenizer.strings = (tokenizer.tokens[:], _Strings(tokenizer.tokens))
    return tokenizer.strings[1]


def _spells(tokenizer, ids: list[list[int]], spelt: list[bytes]) -> list[bool]:
    """Whether the joined tokens of each text are its bytes."""
    if getattr(tokenizer, "lossless", False):
        return [True] * len(ids)
    strings, tokens = _strings(tokenizer), _Tokens()
    tokens.add(ids)
    found = strings.joined(tokens.flat).tobytes()
    upto = np.concatenate([[0], np.cumsum(strings.sizes[tokens.flat])])  # bytes before each token
    ends = upto[np.cumsum(tokens.sizes)].tolist()
    return [found[start:end] == s for start, end, s in zip([0, *ends], ends, spelt)]


def _aligned(batches: Iterator[pa.RecordBatch], folder: str, names: tuple[str, str]):
    """``(ids column, alignments)`` of small runs of rows."""
    first, second = (_load(folder, name) for name in names)
    held = _stretches(first, second)
    for batch in batches:
        texts = batch.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(sizes) - sizes) // PIECE_BYTES
        for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(run)) + 1):
            if len(part):
                here = batch.slice(int(part[0]), len(part))
                yield here.column(0), align_texts(here.column(1).to_pylist(), first, second, held)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])])
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZERS,
                    names: tuple[str, str] = (FIRST, SECOND)) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_sizes, b_sizes``: token ids, and how many of them each group has."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _aligned(batches, folder, names):
            columns = [_lists([x[i] for x in found], pa.int32()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *IDS])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ship(__name__)
    return rows.mapInArrow(align, f"doc_id {kind}, " + ", ".join(f"{c} {ALIGNED}" for c in IDS))


# -------------------------------------------------------------------- digests
def _group_digests(found: list[tuple], written: _Strings) -> list[str]:
    """sha256 of ``a1,a2|b1;a3|b2,b3`` per text; empty without tokens.

    ``written`` has every id with a comma, then with a bar, then with a semicolon behind it.
    """
    k, out = len(written.sizes) // 3, []
    for a, b, a_sizes, b_sizes in found:
        if not len(a):
            out.append("")
            continue
        a_upto, b_upto = np.cumsum(a_sizes), np.cumsum(b_sizes)
        codes = np.empty(len(a) + len(b), np.int64)
        a_code, b_code = a.astype(np.int64), b.astype(np.int64)
        a_code[a_upto - 1] += k
        b_code[b_upto - 1] += 2 * k
        codes[np.arange(len(a)) + np.repeat(b_upto - b_sizes, a_sizes)] = a_code
        codes[np.arange(len(b)) + np.repeat(a_upto, b_sizes)] = b_code
        out.append(hashlib.sha256(written.joined(codes)[:-1]).hexdigest())
    return out


def _links(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """Pairs of ids that end together: the last tokens of each group."""
    a_last, b_last = a[np.cumsum(a_sizes) - 1], b[np.cumsum(b_sizes) - 1]
    return a_last.astype(np.int64) << SHIFT | b_last


BLOCKS = ("block long, {id}, n_a long, n_b long, n_groups long, groups_sha256 string, codes binary, "
          "pairs array<long>, times array<long>")


def _planes(codes: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, lowest first: one value to Spark, and the high planes compress to little."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _number_links(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of rows ``(id, n_a, n_b, sha, links)``: links become numbers of the block's distinct pairs.

    The pairs and their counts are in the block's first row.
    """
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def block() -> pa.RecordBatch:
        links = np.concatenate([r[4] for r in held])
        codes, pairs = pd.factorize(links)
        times = np.bincount(codes, minlength=len(pairs))
        ends = np.cumsum([len(r[4]) for r in held])
        empty = [None] * (len(held) - 1)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(held), task << 32 | number)), pa.array([r[0] for r in held], schema.field(1).type),
            *(pa.array([r[i] for r in held], pa.int64()) for i in (1, 2)), pa.array([len(r[4]) for r in held], pa.int64()),
            pa.array([r[3] for r in held], pa.string()), pa.array([_planes(c) for c in np.split(codes, ends[:-1])], pa.binary()),
            pa.array([pairs, *empty], pa.list_(pa.int64())), pa.array([times, *empty], pa.list_(pa.int64()))],
            schema.names)

    for row in rows:
        held.append(row)
        size += len(row[4])
        if size >= BLOCK_LINKS:
            yield block()
            number, held, size = number + 1, [], 0
    if held:
        yield block()


def link_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZERS,
                names: tuple[str, str] = (FIRST, SECOND)) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    layout = BLOCKS.format(id=f"doc_id {kind.simpleString()}")
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], layout).schema)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = max(len(_load(folder, name).tokens) for name in names)
        written = _Strings([f"{i}{mark}".encode() for mark in ",|;" for i in range(n)])

        def found() -> Iterator[tuple]:
            for ids, aligned in _aligned(batches, folder, names):
                digests = _group_digests(aligned, written)
                for i, x, digest in zip(ids.to_pylist(), aligned, digests):
                    yield i, len(x[0]), len(x[1]), digest, _links(*x) if len(x[0]) else np.empty(0, np.int64)

        yield from _number_links(found(), schema)

    ship(__name__)
    blocks = materialise(rows.mapInArrow(describe, layout), "alignment-blocks")
    own = blocks.where("pairs is not null").select(
        "block", F.posexplode(F.arrays_zip("pairs", "times")).alias("code", "e")).select(
        "block", "code", F.col("e.pairs").alias("pair"), F.col("e.times").alias("times"))
    counts = own.groupBy("pair").agg(F.sum("times").alias("count"))
    second = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    top = F.max("count").over(Window.partitionBy(second))  # at most one row per id of the first vocabulary
    judged = counts.select("pair", "count", (F.col("count") == top).alias("best"))
    answers = own.join(judged, "pair").select(F.col("block").alias("of_block"), "code", "count", "best")

    def score(block: pa.Table, answer: pa.Table) -> pa.Table:
        n = answer.num_rows
        code = answer.column("code").to_numpy()
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        count[code] = answer.column("count").to_numpy()
        best[code] = answer.column("best").to_numpy(zero_copy_only=False)
        codes = [_numbers(c) for c in block.column("codes").to_pylist()]
        best_sum, count_sum = ([int(values[c].sum()) for c in codes] for values in (best, count))
        kept = block.select(["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
        return (kept.append_column("n_best", pa.array(best_sum, pa.int64()))
                .append_column("count_sum", pa.array(count_sum, pa.int64())))

    wide = f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long"
    scored = (blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "codes").groupBy("block")
              .cogroup(answers.groupBy("of_block")).applyInArrow(score, wide))
    # a group's last tokens are its one link
    return scored.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
