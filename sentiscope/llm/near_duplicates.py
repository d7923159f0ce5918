"""Operator 3: near-duplicate documents by DartMinHash signatures and banded joining.

A document is a weighted set of 5-word shingles (lower case; weight ``1 + ln`` of the
count).  DartMinHash throws hashed darts: every unit cell of an element's weight region
holds a Poisson process of darts along the rank axis, drawn from hashes of the cell
alone, so all documents share the darts of common elements.  Darts below a rank that
gives a document about ``k (ln k + 4)`` of them fall into ``k`` coordinates; the earliest
dart inside the region is the coordinate's value (a document with an empty coordinate
throws again with twice the rank).  Two documents agree in a coordinate with their
weighted Jaccard similarity as probability.  Links are decided by the similarity of the
shingle sets, which counts a repeated shingle once; so a document that repeats shingles
also has the bands of its signature with unit weights, and any two documents agree in a
coordinate of these with the very similarity that is decided on (without repetitions both
signatures are the same).

Joining.  Texts with the same words are one node first, so thousands of copies cost one
signature row in the joins.  Nodes that agree in one of ``bands`` bands of ``rows``
coordinates share a bucket; nodes that also agree in the following bands share finer
buckets (``DEPTHS`` bands in a row).  Each member first meets its bucket's least node (its pivot),
and the exact Jaccard similarity of the two shingle sets decides on a link; connected
members are then settled.  In ``TURNS`` further turns each member of a bucket with
several components meets a drawn member of another one.  So nearly all members are
settled by work that grows with the nodes alone.

What is left are pairs of different components in a bucket.  They are settled exactly, and
without forming all pairs, by the members' differences from the pivot.  With ``D(x)`` the symmetric difference of x's
set and the pivot's, two sets differ just where their differences do, so a link needs at least
``c = (|D(x)| + |D(y)| - (|x| + |y|) (1 - t) / (1 + t)) / 2`` common elements of ``D(x)`` and ``D(y)``.
Where c is not positive both are linked to the pivot, hence in one component already.  So every
pair left has a common element, and one among the rarest ``|D| - c + 1`` elements of each (the prefix
filter, with the least c that a member can have beside its pivot; elements that one member alone has are no help and go).
Members meet by (pivot, element), and the number of common elements (by 16 bits of each, never counted too low) is
compared with c in the join, which so gives hardly a pair that is no link; the sets decide in the end.  Nothing
but the banding itself (3e-6 at similarity 0.8) loses a link.  Classes
are the connected components of the links.

Defined results: a text of one to four words is one shingle; a null text or one without
words is a class of its own; repeated rows and exact copies share a class; the class id
is its least document id (null ids do not count); an empty table gives no rows.  Only
the named columns are read, and added ones get names that do not clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import fresh_name, materialise, ship, text_key, text_or_empty

ship(__name__)

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
DEPTHS = (1, 2, 4)
TURNS = 2
CHUNK_WORDS = 1_000_000


# ------------------------------------------------------------------ hashing
def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def shingles(words: list[str], lengths: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of every shingle of documents laid end to end."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = len(hashes)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)  # words from here to the document's end
    inside = np.repeat(lengths, lengths) - left
    combined = np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64)
    for i in range(size):
        ahead = np.zeros(n, dtype=np.uint64)
        ahead[: n - i] = hashes[i:]
        combined = np.where(left > i, _mix(combined ^ ahead) + np.uint64(i), combined)
    whole = (left >= size) | (inside == 0)  # a short text is one shingle
    return doc[whole], combined[whole]


def weighted(doc: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements per document with their weights ``1 + ln(count)``."""
    order = np.lexsort((element, doc))
    doc, element = doc[order], element[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (element[1:] != element[:-1])]) if len(doc) else order
    counts = np.diff(np.r_[first, len(doc)])
    return doc[first], element[first], 1.0 + np.log(np.maximum(counts, 1))


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """``n_docs x k`` signature values; documents must have at least one element."""
    signature = np.zeros((n_docs, k), dtype=np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    limit = k * (np.log(k) + 4.0) / np.maximum(total, 1e-9)
    # unit cells of the weight regions
    cells = np.ceil(weight).astype(np.int64)
    owner = np.repeat(np.arange(len(doc)), cells)
    cell = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = _mix(element[owner] + cell.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    owner_doc, room = doc[owner], weight[owner] - cell
    todo = total > 0
    while todo.any():
        best = np.full(n_docs * k, np.inf)
        value = np.zeros(n_docs * k, dtype=np.uint64)
        live = np.flatnonzero(todo[owner_doc])
        rank = np.zeros(len(live))
        step = 0
        while len(live):
            step += 1
            dart = _mix(seed[live] + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
            rank = rank - np.log(_unit(dart))
            near = rank < limit[owner_doc[live]]
            live, rank, dart = live[near], rank[near], dart[near]
            inside = _unit(_mix(dart ^ np.uint64(0xA5A5A5A5A5A5A5A5))) < room[live]
            at = owner_doc[live][inside] * k + (_mix(dart[inside] + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(k)).astype(np.int64)
            hit_rank, hit_dart = rank[inside], dart[inside]
            np.minimum.at(best, at, hit_rank)
            earliest = best[at] == hit_rank
            value[at[earliest]] = hit_dart[earliest]
        full = np.isfinite(best).reshape(n_docs, k).all(axis=1)
        done = todo & full
        signature[done] = value.reshape(n_docs, k)[done]
        todo &= ~full
        limit = limit * 2
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket number per band, which holds the band's number too."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key ^ parts[:, :, i]) + np.uint64(i)
    return key.view(np.int64)


# -------------------------------------------------------------- map functions
def _chunks(texts, chunk_words: int) -> Iterator[tuple[slice, list[list[str]]]]:
    """Slices of a batch with about ``chunk_words`` words, and their words in lower case."""
    start, held, words = 0, 0, []
    for i, text in enumerate(texts):
        words.append(text.lower().split() if isinstance(text, str) else [])
        held += len(words[-1])
        if held >= chunk_words:
            yield slice(start, i + 1), words
            start, held, words = i + 1, 0, []
    if words:
        yield slice(start, start + len(words)), words


def _sign(bands: int, rows: int, size: int, chunk_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, words in _chunks(batch["text"], chunk_words):
                lengths = np.array([len(w) for w in words], dtype=np.int64)
                doc, element, weight = weighted(*shingles([x for w in words for x in w], lengths, size))
                signature = dart_signatures(doc, element, weight, len(words), bands * rows)
                keys = list(band_keys(signature, bands, rows))
                # documents that repeat a shingle: bands of the plain set too
                repeating = np.unique(doc[weight > 1])
                if len(repeating):
                    of = np.isin(doc, repeating)
                    plain = dart_signatures(np.searchsorted(repeating, doc[of]), element[of], np.ones(int(of.sum())),
                                            len(repeating), bands * rows)
                    for i, key in zip(repeating, band_keys(plain, bands, rows), strict=True):
                        keys[i] = np.r_[keys[i], key]
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[part].array, "text_key": batch["text_key"].iloc[part].array,
                    "words": [hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).digest() if w else None for w in words],
                    "buckets": [k if n else [] for k, n in zip(keys, lengths, strict=True)]})

    return run


def _shingle_sets(size: int, chunk_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, words in _chunks(batch["text"], chunk_words):
                lengths = np.array([len(w) for w in words], dtype=np.int64)
                doc, element, _ = weighted(*shingles([x for w in words for x in w], lengths, size))
                ends = np.cumsum(np.bincount(doc, minlength=len(words)))
                yield pd.DataFrame({"node": batch["node"].iloc[part].array, "set": np.split(element.view(np.int64), ends[:-1])})

    return run


# -------------------------------------------------------------------- graph
def components(links: DataFrame) -> DataFrame:
    """``a, b`` links -> ``node, component`` (least node), by alternating large and small stars.

    Every round is two aggregations by node with map-side minimum and joins that Spark
    can split at a hot node; the loop ends when a round leaves the links as they are.
    """
    def rewired(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seen = both if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = seen.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        spokes = seen.join(least, F.col("a") == F.col("u"))
        if larger:
            new = spokes.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = spokes.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return new.where(F.col("a") != F.col("b")).distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = materialise(links.select("a", "b").distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = materialise(rewired(rewired(edges, True), False), "links")
        after = state(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs ``a, b`` whose shingle sets have at least the similarity."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("s")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("t")), "b"))
    shared = F.size(F.array_intersect("s", "t"))
    return both.where(shared >= threshold * (F.size("s") + F.size("t") - shared) - 1e-9).select("a", "b")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _placed(member: DataFrame, labels: DataFrame) -> DataFrame:
    return member.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _foreign_pivots(met: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Each node of a bucket with several components, paired with one node of another component.

    A bucket's pivot is drawn by a hash of node and turn; the nodes of the pivot's own
    component meet a node of another one.  The pairs of a turn grow with the nodes alone.
    """
    placed = _placed(met, labels)
    drawn = F.xxhash64("node", F.lit(turn))
    by_component = F.struct(F.xxhash64("component", F.lit(turn)).alias("h"), drawn.alias("r"), "component", "node")
    pivots = placed.groupBy("bucket").agg(
        F.min(F.struct(drawn.alias("r"), "component", "node")).alias("p"),
        F.min(by_component).alias("low"), F.max(by_component).alias("high")).where(
        F.col("low.component") != F.col("high.component"))
    other = F.when(F.col("low.component") != F.col("p.component"), F.col("low.node")).otherwise(F.col("high.node"))
    pivots = pivots.select("bucket", F.col("p.component").alias("home"), F.col("p.node").alias("pivot"), other.alias("other"))
    met_by = placed.join(pivots, "bucket").select(
        "node", F.when(F.col("component") == F.col("home"), F.col("other")).otherwise(F.col("pivot")).alias("pivot"))
    return met_by.select(*_ordered("node", "pivot")).distinct()


def _remaining(member: DataFrame, labels: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` of different components, all links among those that share a bucket (``member``: ``node, bucket``) and few others.

    See the module's text for the filter.  Members meet by their buckets' pivot: two that share
    a bucket share its pivot, and pairs with the pivot have been tested.
    """
    slack = (1 - threshold) / (1 + threshold)
    pivots = member.groupBy("bucket").agg(F.min("node").alias("pivot"))
    met = member.join(pivots, "bucket").where(F.col("node") != F.col("pivot")).select("pivot", "node").distinct()
    placed = materialise(_placed(met, labels), "placed")
    mixed = placed.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        F.col("low") != F.col("high")).select("pivot")
    both = (placed.join(mixed, "pivot").join(sets, "node")
            .join(sets.select(F.col("node").alias("pivot"), F.col("set").alias("of")), "pivot"))
    apart = F.concat(F.array_except("set", "of"), F.array_except("of", "set"))
    far = F.size("apart") - F.lit(slack) * F.col("n")
    rows = materialise(both.select("pivot", "node", "component", F.size("set").alias("n"), apart.alias("apart"))
                       .withColumn("far", far), "differences")
    # the rarest elements of each difference among those of its pivot; those that it has alone come first and help no pair
    elements = rows.select("pivot", "node", F.explode("apart").alias("element"))
    often = elements.groupBy("pivot", "element").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    known = (elements.join(often, ["pivot", "element"]).groupBy("pivot", "node")
             .agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("known")))
    nearest = rows.groupBy("pivot").agg(F.min("far").alias("nearest"))
    # the other set has at most n / threshold elements, and at most slack times both sizes of D(x) is not in D(y)
    own = F.col("far") - F.lit(slack / threshold) * F.col("n")
    common = F.greatest(F.lit(1.0), F.ceil((F.col("far") + F.col("nearest")) / 2 - 1e-6), F.ceil(own - 1e-6)).cast("int")
    rest = F.size("known") - common + 1
    narrow = rows.select("pivot", "node", "component", "n", "far").join(nearest, "pivot").join(known, ["pivot", "node"])
    # 16 bits of each element count what is common; ``twins`` makes up for elements of one set with equal bits
    bits = F.transform("known", lambda e: e["element"].bitwiseAND(F.lit(0x7FFF)).cast("smallint"))
    ranked = narrow.where(rest > 0).select(
        "pivot", "node", "component", "n", "far", F.array_distinct(bits).alias("codes"),
        (F.size("known") - F.size(F.array_distinct(bits))).alias("twins"),
        F.transform(F.slice("known", F.lit(1), rest), lambda e: e["element"]).alias("prefix"))
    ranked = materialise(ranked, "prefixes")
    # dealt out once for both sides
    left = ranked.withColumn("element", F.explode("prefix")).drop("prefix").repartition("pivot", "element")
    right = left.select(*[F.col(c).alias(f"other_{c}") for c in left.columns])
    needed = F.col("far") + F.col("other_far") - 1e-6
    spare = F.least("twins", "other_twins")
    alike = ((F.col("component") < F.col("other_component"))
             & (F.least("n", "other_n") >= threshold * F.greatest("n", "other_n") - 1e-9)
             & (2 * (F.least(F.size("codes"), F.size("other_codes")) + spare) >= needed)
             & (2 * (F.size(F.array_intersect("codes", "other_codes")) + spare) >= needed))
    at = (F.col("pivot") == F.col("other_pivot")) & (F.col("element") == F.col("other_element"))
    return left.join(right, at & alike).select(*_ordered("node", "other_node")).distinct()


def near_duplicate_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                           threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                           chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row per document: ``doc_id, text_key, component, class_id, class_size``.

    ``text_key`` is the digest of the text by which callers join back.  ``component`` tells
    classes apart, whatever the ids (null for a document without words, a class of its own);
    ``class_id`` is the least id in the class that is not null, null if it has none, and
    two classes share it if an id repeats with different texts.
    """
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    texts = texts.withColumn("text_key", text_key(F.col("text")))
    signed = materialise(texts.mapInPandas(
        _sign(bands, rows, size, chunk_words),
        f"doc_id {kind}, text_key string, words binary, buckets array<long>"), "signatures")
    # a node gets a short number, unique as the table is written once
    nodes = materialise(signed.where(F.col("words").isNotNull()).groupBy("words")
                        .agg(F.min("text_key").alias("text_key"), F.any_value("buckets").alias("buckets"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    member = nodes.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    shared = materialise(member.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where(
        F.col("low") != F.col("high")).select("bucket"), "shared")
    # nodes that share a bucket, and their buckets of every depth
    wanted = materialise(nodes.join(member.join(shared, "bucket").select("node").distinct(), "node")
                         .select("node", "text_key", "buckets"), "wanted")
    chosen = texts.join(wanted.select("node", "text_key"), "text_key").dropDuplicates(["node"]).select("node", "text")
    sets = materialise(chosen.mapInPandas(_shingle_sets(size, chunk_words), "node long, set array<long>"), "shingles")

    def finer(first: int):
        ring = F.concat(F.slice("buckets", first, bands), F.slice("buckets", first, max(DEPTHS)))
        starts = F.sequence(F.lit(1), F.lit(bands))

        def deep(d: int):  # a function of one argument: a second one would be taken for the index
            return F.transform(starts, lambda i: F.xxhash64(F.slice(ring, i, F.lit(d))))

        return F.concat(*[deep(d) for d in DEPTHS])

    plain = F.when(F.size("buckets") > bands, finer(bands + 1)).otherwise(F.array().cast("array<bigint>"))
    met = wanted.select("node", F.explode(F.array_distinct(F.concat(finer(1), plain))).alias("bucket"))
    crowded = met.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("high")).where(
        F.col("pivot") != F.col("high")).select("bucket", "pivot")
    met = materialise(met.join(crowded, "bucket"), "buckets")

    tried = materialise(met.where(F.col("node") != F.col("pivot")).select(*_ordered("node", "pivot")).distinct(), "pairs")
    met = met.select("node", "bucket")
    links = materialise(_linked(tried, sets, threshold), "linked")
    labels = components(links)
    for turn in range(1, TURNS + 1):
        pairs = materialise(_foreign_pivots(met, labels, turn).join(tried, ["a", "b"], "left_anti"), "pairs")
        new = materialise(_linked(pairs, sets, threshold), "linked")
        links, tried = links.unionByName(new), tried.unionByName(pairs)
        labels = components(links)
    # members of the single bands, where all pairs that the banding finds share a bucket
    single = wanted.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    rest = materialise(_remaining(single.join(shared, "bucket"), labels, sets, threshold), "pairs")
    labels = components(links.unionByName(materialise(_linked(rest, sets, threshold), "linked")))
    # classes by the words of their least node
    words = nodes.select("node", "words")
    named = labels.join(words, "node").join(
        words.select(F.col("node").alias("component"), F.col("words").alias("c")), "component").select("words", "c")
    of_node = signed.select("doc_id", "text_key", "words").join(named, "words", "left").select(
        "doc_id", "text_key", F.coalesce("c", "words").alias("c"))
    classes = (of_node.where(F.col("c").isNotNull()).groupBy("c")
               .agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return of_node.join(classes, "c", "left").select(
        "doc_id", "text_key", F.col("c").alias("component"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the least id of each class, with its own columns; documents without words all stay.

    A null id comes after all others, and of one id the least text digest stays.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    key = fresh_name(docs, "_key")
    classes = materialise(near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **options), "classes")
    several = classes.where(F.col("class_size") > 1)
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_key")
    first = several.groupBy("component").agg(F.min(order).alias("first"))
    gone = several.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies")).join(first, "component")
    stays = order.eqNullSafe(F.col("first"))
    verdict = materialise(gone.where(~stays | (F.col("copies") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), stays.alias("_stays")), "verdicts")
    verdict = verdict.toDF(*[fresh_name(docs, c) for c in verdict.columns])
    i, t, s = verdict.columns
    keyed = docs.withColumn(key, text_key(text_or_empty(text_col)))
    same = (F.col(f"`{id_col}`").eqNullSafe(F.col(i))) & (F.col(key) == F.col(t))
    single = keyed.join(verdict, same, "left_anti").select(*own)
    # repeated rows of one id and text: one of them stays
    twice = verdict.where(F.col(s))
    repeated = keyed.join(twice, same).dropDuplicates([id_col, key]).select(*own)
    return single.unionByName(repeated)
