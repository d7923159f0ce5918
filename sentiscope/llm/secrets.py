"""Operator 9: secret scan with multipart credential linking.

Base kinds are found by their patterns and always reported.  Weak candidates - other
access identifiers, long random strings, endpoints - mean little alone; they are
reported only where complementary parts stand together:

* ``weak_access`` next to a secret (``assign``, ``hex`` or ``weak_secret``);
* ``weak_secret`` next to an identifier (``access`` or ``weak_access``);
* ``endpoint`` next to both an identifier and a secret.

"Next to" is an interval join within the document: the gap between two parts, from the greatest stop before
a part or to the least start after it, is at most ``scope`` code points (overlapping parts have none).  It is
evaluated by running windows over the document's parts in both directions, linear in their number.  A weak
part that overlaps a base span is no part of its own, nor is a secret that overlaps an identifier.

Every identifier is linked with the nearest secret of its scope and every secret with the nearest identifier (ties:
the one before); a link also has the endpoint nearest to the identifier, if its scope has one.

A match's place is the sum of the pieces that splitting at the pattern leaves before
it, a running sum over the document's matches.  Only lengths of matches and pieces are
shuffled, never texts, and every step is a built-in function.

Defined results: a null or empty text has no span; every row gets one result, also
repeated ones; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentiscope.llm.common import fresh_name, text_key, text_or_empty

SCOPE = 200
MASK = "[SECRET]"

# Fixed values: (kind, pattern, group that is measured, its least length).
BASE = (
    ("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    # a shorter run of these two has no longer match inside, so the least length stands in the pattern
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    ("weak_access", "(?<![A-Za-z0-9])(?:(?:ASIA|AROA|AIDA|AGPA)[A-Z0-9]{12,}"
                    "|(?i:client_?id|account_?id|access_?key_?id|user_?name|user|login)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.@-]+)", 0, 1),
    ("weak_secret", "(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{32,}={0,2}", 0, 32),
    ("endpoint", "(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|s3)://[^\\s\"'<>]+", 0, 1),
)
KINDS = BASE + WEAK


def _pieces(text: Column, number: int, pattern: str, group: int) -> Column:
    """Per match: kind number, place in order, length of the piece before it, of the match, of the measured group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern), lambda p: F.length(p))
    sizes = F.transform(F.arrays_zip(whole.alias("a"), measured.alias("b")),
                        lambda m: F.struct(F.length(m["a"]).alias("n"), F.length(m["b"]).alias("g")))
    found = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda p, m: F.struct(
        F.lit(number).alias("kind"), p.alias("gap"), m["n"].alias("n"), m["g"].alias("g")))
    placed = F.transform(found, lambda x, i: F.struct(x["kind"].alias("kind"), i.alias("i"), x["gap"].alias("gap"),
                                                      x["n"].alias("n"), x["g"].alias("g")))
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,n:int,g:int>>")
    return F.when(text.rlike(pattern), placed).otherwise(empty)


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: ``row, doc_id``, ``spans`` (sorted structs ``start, kind, stop``) and ``credentials``.

    ``kind`` is the place in :data:`KINDS`; places are code points, ``stop`` exclusive.  ``credentials`` are sorted
    structs of the spans ``identifier``, ``secret`` and ``endpoint`` (null without one).
    ``row`` numbers the input rows within this result.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    found = F.concat(*[_pieces(F.col("t"), i, pattern, group) for i, (_, pattern, group, _) in enumerate(KINDS)])
    # one exchange: both windows and the last aggregation work by row
    parts = (texts.select("row", "doc_id", F.explode_outer(found).alias("m")).select("row", "doc_id", "m.*")
             .repartition("row"))
    running = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.get(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind"))
    placed = (parts.withColumn("stop", F.sum(F.col("gap") + F.col("n")).over(running))
              .withColumn("start", F.col("stop") - F.col("n"))
              # a match that fails keeps its row, without a kind, so that the document keeps its result
              .withColumn("kind", F.when(F.col("g") >= least, F.col("kind"))))

    kind = {name: F.col("kind") == i for i, (name, *_) in enumerate(KINDS)}
    base = F.col("kind") < len(BASE)
    of_row = Window.partitionBy("row")
    before = of_row.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = of_row.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    edges = {"base": base, "access": kind["access"], "weak_access": kind["weak_access"]}
    marked = (placed.withColumns({f"{n}_stop": F.max(F.when(c, F.col("stop"))).over(before) for n, c in edges.items()})
              .withColumns({f"{n}_start": F.min(F.when(c, F.col("start"))).over(behind) for n, c in edges.items()}))

    def apart(name: str) -> Column:
        return ((F.coalesce(f"{name}_stop", F.lit(-1)) <= F.col("start"))
                & (F.coalesce(f"{name}_start", F.col("stop")) >= F.col("stop")))

    parts = marked.select(
        "row", "doc_id", "kind", "start", "stop",
        (kind["access"] | (kind["weak_access"] & apart("base"))).alias("is_identifier"),
        (kind["hex"] | (kind["assign"] & apart("access"))
         | (kind["weak_secret"] & apart("base") & apart("weak_access"))).alias("is_secret"),
        (kind["endpoint"] & apart("base")).alias("is_endpoint"))

    def nearest(name: str) -> Column:
        """The nearest part of a class within the scope, from the columns that ``sides`` adds."""
        left, right = F.col(f"{name}_left"), F.col(f"{name}_right")
        left_gap = F.greatest(F.col("start") - left["stop"], F.lit(0))
        right_gap = F.greatest(right["start"] - F.col("stop"), F.lit(0))
        first = left.isNotNull() & (left_gap <= scope) & (right.isNull() | (left_gap <= right_gap))
        return F.when(first, left["part"]).when(right.isNotNull() & (right_gap <= scope), right["part"])

    span = F.struct("start", "kind", "stop")

    def sides(df: DataFrame, classes: dict[str, Column]) -> DataFrame:
        ended = {f"{n}_left": F.max(F.when(F.col(f"is_{n}"), F.struct("stop", part.alias("part")))).over(before)
                 for n, part in classes.items()}
        begun = {f"{n}_right": F.min(F.when(F.col(f"is_{n}"), F.struct("start", part.alias("part")))).over(behind)
                 for n, part in classes.items()}
        return df.withColumns(ended).withColumns(begun)

    parts = sides(parts, {"endpoint": span}).withColumn("endpoint", nearest("endpoint")).drop("endpoint_left", "endpoint_right")
    whole = F.struct(span.alias("span"), F.col("endpoint").alias("endpoint"))
    parts = sides(parts, {"identifier": whole, "secret": span}).select(
        "row", "doc_id", "kind", "start", "stop", "endpoint", "is_identifier", "is_secret", "is_endpoint",
        nearest("identifier").alias("identifier"), nearest("secret").alias("secret"))

    identifier, secret = F.col("identifier"), F.col("secret")
    complement = ((F.col("is_identifier") & secret.isNotNull()) | (F.col("is_secret") & identifier.isNotNull())
                  | (F.col("is_endpoint") & identifier.isNotNull() & secret.isNotNull()))

    def link(own: Column, other: Column, endpoint: Column) -> Column:
        return F.struct(own.alias("identifier"), other.alias("secret"), endpoint.alias("endpoint"))

    linked = (F.when(F.col("is_identifier") & secret.isNotNull(), link(span, secret, F.col("endpoint")))
              .when(F.col("is_secret") & identifier.isNotNull(), link(identifier["span"], span, identifier["endpoint"])))
    return (parts.groupBy("row").agg(F.any_value("doc_id").alias("doc_id"),
                                     F.sort_array(F.collect_list(F.when(base | complement, span))).alias("spans"),
                                     F.sort_array(F.collect_set(linked)).alias("credentials")))


def _name(span: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.concat_ws(":", F.get(names, span["kind"]), span["start"], span["stop"])


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, _name), ",")


def report(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans, all spans and the links as text.

    A link is ``kind:start:stop`` of its parts, joined by ``+``; links are joined by commas.
    """
    def number(i):
        return F.size(F.filter("spans", lambda s: s.kind == i)).cast("long")

    counts = [number(i).alias(f"n_{name}") for i, (name, *_) in enumerate(BASE)]
    base = F.filter("spans", lambda s: s.kind < len(BASE))
    return found.select("doc_id", *counts, F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("credentials", lambda c: F.concat_ws(
                            "+", _name(c["identifier"]), _name(c["secret"]),
                            F.when(c["endpoint"].isNotNull(), _name(c["endpoint"])))), ",").alias("credentials"))


def mask_secrets(docs: DataFrame, *, text_col: str = "text", scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; all other rows and columns as they are.

    Only rows in which some pattern occurs are joined with their spans, by a digest of
    the text, on which the spans depend alone.  Overlapping spans become one mask.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    key, cuts = fresh_name(docs, "_key"), fresh_name(docs, "_cuts")
    text = text_or_empty(text_col)
    probe = F.lit(False)
    for _, pattern, *_ in KINDS:
        probe = probe | text.rlike(pattern)
    some = docs.where(probe).withColumn(key, text_key(text))
    found = find_secrets(some, id_col=key, text_col=text_col, scope=scope)
    found = found.where(F.size("spans") > 0).groupBy(F.col("doc_id").alias(key)).agg(F.any_value("spans").alias("spans"))
    merged = F.aggregate(
        "spans", F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda out, s: F.when((F.size(out) > 0) & (F.element_at(out, -1).b > s.start), F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.struct(F.element_at(out, -1).a.alias("a"), F.greatest(F.element_at(out, -1).b, s.stop).alias("b")))))
        .otherwise(F.concat(out, F.array(F.struct(s.start.cast("long").alias("a"), s.stop.cast("long").alias("b"))))))
    found = found.select(key, merged.alias(cuts))
    c = F.col(cuts)
    begins = F.concat(F.array(F.lit(0).cast("long")), c["b"])
    ends = F.concat(c["a"], F.array(F.length(text).cast("long")))
    pieces = F.zip_with(begins, ends, lambda b, e: F.substring(text, (b + 1).cast("int"), (e - b).cast("int")))
    masked = some.join(found, key, "left").withColumn(
        text_col, F.when(c.isNotNull(), F.array_join(pieces, mask)).otherwise(F.col(text_col)))
    return docs.where(~probe).select(*own).unionByName(masked.select(*own))
