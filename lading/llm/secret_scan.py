"""Secrets in whole texts, in Spark SQL functions.

Base kinds are regular expressions, leftmost and non-overlapping per kind:
``assign`` (a keyword, ``:`` or ``=``, and a value of 8 or more characters),
``access`` (``AKIA`` ids of 16 or more), ``hex`` (runs of 32 or more).

Multipart linking adds weak candidates that are only reported when the parts
that complete them occur in the same scope (``SCOPE`` code points around them
in the same text): ``part``, a bare 40-character key, next to an access id;
``endpoint``, a URL, next to an access id and a secret (``assign``, ``hex`` or
a reported ``part``).  The link is an interval join: parts of a text are
exploded, spread over buckets of ``SCOPE`` code points, joined on text and
bucket, and compared exactly.  Texts are keyed by a 128-bit hash, so copies
are searched once and no id has to be unique; only texts with an access id
enter the join.

Spans are (kind, start, end) in code points, end exclusive, ordered by start,
then kind as listed above.  Null and empty texts have none.  Repeated rows
give repeated results; extra columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.columns import fresh
from lading.llm.graph import written

KINDS = ["assign", "access", "hex", "part", "endpoint"]
SCOPE = 400
MARK = "[SECRET]"

# Fixed patterns of the base kinds.
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{12,}"  # the longest run is taken, so 16 or more in all
_HEX = r"[0-9a-f]{32,}"
_PART = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
_ENDPOINT = r"""https?://[^\s"'<>]+"""

_SPAN = "struct<start:int,rank:int,kind:string,end:int>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` refers
    to it inside other lambda functions."""
    return F.transform(F.array(value), use)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running(values: Column) -> Column:
    """Running sums before each element.  Sums of blocks of about the square
    root of the length keep long arrays far from quadratic work."""
    def blocks(v: Column, width: Column) -> Column:
        count = F.ceil(F.size(v) / width).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: _sum(F.slice(v, b * width + 1, width)))
        return bound(sums, lambda s: bound(
            F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.when(b == 0, 0).otherwise(_sum(F.slice(s, 1, F.greatest(b, F.lit(1)))))),
            lambda before: F.transform(v, lambda x, i: before[F.floor(i / width).cast("int")] + F.when(i % width == 0, 0).otherwise(
                _sum(F.slice(v, (i - i % width) + 1, F.greatest(i % width, F.lit(1))))))))

    return bound(values, lambda v: bound(F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int"), lambda w: blocks(v, w)))


def find(text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of a pattern's matches.  The text between matches gives their
    places; it is split only where there is a match."""
    rank = KINDS.index(kind)

    def spans(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.length(g) + F.length(m))
        found = bound(running(steps), lambda before: bound(gaps, lambda g: F.transform(matches, lambda m, i: F.struct(
            (before[i] + F.length(g[i])).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            (before[i] + F.length(g[i]) + F.length(m)).alias("end"), m.alias("match")))))
        if keep is not None:
            found = F.filter(found, lambda s: keep(s["match"]))
        return F.transform(found, lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"]))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                 lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(F.expr(_NONE)))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind."""
    value = lambda m: F.length(F.regexp_extract(m, _ASSIGN, 2)) >= 8
    has = text.contains("AKIA")
    return {"assign": find(text, _ASSIGN, "assign", value),
            "access": F.when(has, find(text, _ACCESS, "access")).otherwise(F.expr(_NONE)),
            "hex": find(text, _HEX, "hex")}


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak candidates with their complementary parts in scope: k1, k2, span."""
    def spread(df: DataFrame, margin: int) -> DataFrame:
        return df.withColumn("bucket", F.explode(F.sequence(
            F.floor((F.col("span.start") - margin) / scope), F.floor((F.col("span.end") + margin - 1) / scope))))

    def near(weak: DataFrame, strong: DataFrame) -> DataFrame:
        a, b = spread(weak, 0).alias("a"), spread(strong, scope).alias("b")
        met = ((F.col("a.k1") == F.col("b.k1")) & (F.col("a.k2") == F.col("b.k2")) & (F.col("a.bucket") == F.col("b.bucket"))
               & (F.col("a.span.start") < F.col("b.span.end") + scope) & (F.col("b.span.start") < F.col("a.span.end") + scope))
        return a.join(b, met, "left_semi").select("k1", "k2", "span").distinct()

    def of(*kinds: str) -> DataFrame:
        return parts.where(F.col("span.kind").isin(*kinds))

    access = of("access")
    part = near(of("part"), access)
    endpoint = near(near(of("endpoint"), access), of("assign", "hex").unionByName(part))
    return part.unionByName(endpoint)


def scan(docs: DataFrame, *, text_col: str = "text", spans_col: str = "secret_spans", scope: int = SCOPE) -> DataFrame:
    """``docs`` with an array of spans (start, rank, kind, end).  Texts stay
    where they are; only rows with an access id meet the join's result."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = F.array_sort(F.concat(*base_spans(text).values()))
    has = text.contains("AKIA")
    plain = docs.where(~has).withColumn(spans_col, base)
    k1, k2, extra = (fresh(docs, c) for c in ("text_k1", "text_k2", "linked_spans"))
    keys = {k1: F.xxhash64(text), k2: F.xxhash64(F.lit(5), text)}
    some = docs.where(has)
    kinds = base_spans(text) | {"part": find(text, _PART, "part"), "endpoint": find(text, _ENDPOINT, "endpoint")}
    # Spark turns explode into a filter beside the one on the text and evaluates what
    # repeats in it first: only a condition keeps the searches to the rows that have one.
    found = F.when(has, F.concat(*kinds.values())).otherwise(F.expr(_NONE))
    parts = (some.select(keys[k1].alias("k1"), keys[k2].alias("k2"), found.alias("spans"))
             .select("k1", "k2", F.explode("spans").alias("span")).distinct())
    parts = written(parts, "secret-parts")  # read by each side of the joins
    added = (_linked(parts, scope).groupBy("k1", "k2").agg(F.collect_list("span").alias(extra))
             .withColumnsRenamed({"k1": k1, "k2": k2}))
    full = (some.withColumns(keys).join(added, [k1, k2], "left")
            .withColumn(spans_col, F.array_sort(F.concat(base, F.coalesce(extra, F.expr(_NONE))))))
    return plain.unionByName(full.select(plain.columns))


def as_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every span (overlapping ones together) replaced."""
    joined = F.aggregate(spans, F.expr("cast(array() as array<struct<start:int,end:int>>)"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))

    def pieces(m: Column) -> Column:
        kept = F.transform(m, lambda s, i: F.concat(
            F.substring(text, F.when(i == 0, 0).otherwise(m[F.greatest(i - 1, F.lit(0))]["end"]) + 1,
                        s["start"] - F.when(i == 0, 0).otherwise(m[F.greatest(i - 1, F.lit(0))]["end"])), F.lit(mark)))
        return F.concat(F.array_join(kept, ""), F.substring(text, F.element_at(m, -1)["end"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, bound(joined, pieces)).otherwise(text)


def digest(found: DataFrame, id_col: str = "doc_id", spans_col: str = "secret_spans") -> DataFrame:
    """The contract's columns."""
    spans = F.col(spans_col)

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(id_col, *[count(k) for k in KINDS[:3]], F.sha2(as_text(F.filter(spans, lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
                        as_text(spans).alias("spans"))
