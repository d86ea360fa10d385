"""Toxicity by maximum-scoring segments.

Tokens are lower-cased letter runs.  A token's score is the log-odds of its
strongest unit (the word itself or one of its first ``PREFIXES`` letters)
between toxic and clean documents, with a Dirichlet prior in proportion to the
unit's share of all documents (Monroe, Colaresi, Quinn 2008), less ``DRIFT``:
units only slightly commoner in toxic documents, of which a large sample has
thousands, count against a passage like unknown tokens, which score ``-DRIFT``.
So do units whose likelihood ratio (Dunning 1993) chance alone would reach in
one of all places (at least ``LEAST_Z`` standard errors).  Units are hashed into
``1 << BITS`` places, so the score table has a fixed size whatever the vocabulary.

A text's tokens are scanned once, and all maximal scoring segments are found in
linear time (Ruzzo, Tompa 1999).  A segment's score S in a text of n tokens is
calibrated as an extreme value: in clean text about K * n * exp(-lambda * S)
segments reach it.  Lambda follows from the tokens' scores in clean documents,
K from the best segments of clean documents.  A passage is significant where
that expectation is at most ``EXPECT``.  The document's evidence is the sum
over its segments of lambda * S - ln(K * n) where positive, and a logistic
curve fitted to the labelled rows turns it into a score from 0 to 1.

Fitting uses labelled rows only, at most ``SAMPLE_ROWS`` a class in the mean,
drawn evenly by a hash of the id (the documented bound); everything else
covers whole texts.  Ids labelled twice with different values, null labels and
labels of unknown documents teach nothing.  Without any learned row the score
is 0, with rows of one class only it is that class's share under the prior.
Null and empty texts have no token, no passage and the score of no evidence.
Letter runs longer than ``PIECE_BYTES`` are cut.  Extra columns are carried or
ignored, repeated rows give repeated results, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.bytetext import byte_slices, lower_ascii, mix64, running_hash
from lading.llm.columns import fresh
from lading.llm.graph import written
from lading.session import ship_package

#: Labelled rows a class that the fit uses in the mean (the documented bound).
SAMPLE_ROWS = 20_000
BITS = 20
#: Lengths in letters of the prefixes that are units beside the whole word.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Documents that the Dirichlet prior is worth.
PRIOR = 10.0
LEAST_Z = 3.0
DRIFT = 1.0
EXPECT = 0.05
#: Bytes of one text scanned at once.
PIECE_BYTES = 1 << 20
#: Steps of evidence for the calibration table, and their number.
STEP, STEPS = 0.25, 400

_U = np.uint64
_FOLD = lower_ascii()
_IS_WORD = np.zeros(256, bool)
_IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


class Tokens:
    """Tokens of a piece of text: starts and ends in bytes, the same in code
    points, and the row bounds (first token of each row, one entry more)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        from lading.llm.bytetext import word_bounds

        self.data = data
        self.starts, self.ends, self.rows = word_bounds(data, offsets, _IS_WORD)
        lead = (data & 0xC0) != 0x80
        self.place = np.flatnonzero(lead)  # byte of each code point
        count = np.concatenate([[0], np.cumsum(lead)])
        self.first, self.last = count[self.starts], count[self.ends]
        self.row_points = count[offsets]

    def units(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per kind of unit: token numbers and their places in the table."""
        total, down = running_hash(self.data, _FOLD)
        letters = self.last - self.first
        for k in (0, *PREFIXES):
            which = np.arange(len(self.starts)) if k == 0 else np.flatnonzero(letters >= k)
            begin = self.starts[which]
            if k == 0:
                end = self.ends[which]
            else:
                at = self.first[which] + k
                end = np.where(at < len(self.place), self.place[np.minimum(at, len(self.place) - 1)], len(self.data))
                end = np.minimum(end, self.ends[which])
            h = mix64((total[end] - total[begin]) * down[begin] + _U((k + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
            yield which, (h >> _U(64 - BITS)).astype(np.int64)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, bool, Tokens]]:
    """Lower-cased pieces of a text column: first row, end row, whether the
    piece goes on with the row before, tokens.  A long text comes in pieces
    that end where no letter run does."""
    import pyarrow.compute as pc

    for i, j, data, offsets in byte_slices(pc.utf8_lower(texts.fill_null("")), PIECE_BYTES):
        if j > i + 1 or len(data) <= PIECE_BYTES:
            yield i, j, False, Tokens(data, offsets)
            continue
        at = 0
        while at < len(data):
            end = min(at + PIECE_BYTES, len(data))
            if end < len(data):
                gaps = np.flatnonzero(~_IS_WORD[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                while (data[end] & 0xC0) == 0x80:  # never inside a code point
                    end -= 1
            yield i, j, at > 0, Tokens(data[at:end], np.array([0, end - at]))
            at = end


def maximal_segments(before: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """All maximal scoring segments (Ruzzo and Tompa).  Positive tokens only:
    ``before`` and ``after`` are the running sums before and after each; what
    lies between two of them is a fall of the sum.  Returns first and last
    token numbers.  Each candidate is pushed once and merged once; the search
    for an earlier lower sum follows stored links."""
    left: list[float] = []
    right: list[float] = []
    span: list[tuple[int, int]] = []
    link: list[int] = []  # the nearest earlier candidate with a lower left sum
    for k, (lo, hi) in enumerate(zip(before.tolist(), after.tolist(), strict=True)):
        start = k
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = link[j]
            if j < 0 or right[j] >= hi:
                left.append(lo)
                right.append(hi)
                span.append((start, k))
                link.append(j)
                break
            lo, start = left[j], span[j][0]
            del left[j:], right[j:], span[j:], link[j:]
    return span


class Model:
    """Scores by place (0: unknown), calibration and its curve.  Its size is
    fixed by ``BITS``."""

    def __init__(self, table: np.ndarray, rate: float, drift: float = DRIFT, scale: float = 1.0, density: float = 1.0,
                 curve: tuple[float, float] | None = None):
        self.table, self.rate, self.drift, self.scale, self.density, self.curve = table, rate, drift, scale, density, curve

    def token_scores(self, tokens: Tokens) -> np.ndarray:
        best = np.zeros(len(tokens.starts), np.float32)
        for which, place in tokens.units():
            value = self.table[place]
            best[which] = np.where(np.abs(value) > np.abs(best[which]), value, best[which])
        return np.where(best == 0, -self.drift, best.astype(np.float64))

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Tokens of each row, and its maximal segments as (start, end, score),
        ends exclusive and in code points."""
        n = np.zeros(len(texts), np.int64)
        found: list[list[tuple[int, int, float]]] = [[] for _ in range(len(texts))]
        held: dict[int, list[tuple]] = {}  # positive tokens of rows that come in pieces
        carry = (0.0, 0)

        def close(row: int, parts: list[tuple]) -> None:
            before, after, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
            found[row] = [(int(first[a]), int(last[b]), float(after[b] - before[a])) for a, b in maximal_segments(before, after)]

        for i, j, goes_on, tokens in _pieces(texts):
            score = self.token_scores(tokens)
            total = np.concatenate([[0.0], np.cumsum(score)])
            good = np.flatnonzero(score > 0)
            if j == i + 1:
                fall, points = carry if goes_on else (0.0, 0)
                held.setdefault(i, []).append((total[good] + fall, total[good + 1] + fall, tokens.first[good] + points, tokens.last[good] + points))
                carry = (fall + total[-1], points + len(tokens.place))
                n[i] += len(score)
                continue
            n[i:j] = np.diff(tokens.rows)
            row = np.searchsorted(tokens.rows, good, "right") - 1
            cuts = np.flatnonzero(np.diff(row)) + 1
            for some in np.split(good, cuts) if len(good) else []:
                r = int(np.searchsorted(tokens.rows, some[0], "right")) - 1
                base, zero = tokens.row_points[r], total[tokens.rows[r]]
                close(i + r, [(total[some] - zero, total[some + 1] - zero, tokens.first[some] - base, tokens.last[some] - base)])
        for row, parts in held.items():
            close(row, parts)
        return n, found

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        floor = math.log(max(self.density * n, 1e-9)) if n else 0.0
        return sum(max(0.0, self.scale * s - floor) for _, _, s in segments)

    def score(self, evidence: float) -> float:
        if self.curve is None:
            return self.rate
        a, b = self.curve
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, a + b * math.sqrt(evidence)))))


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a unit, summed over a task."""
    seen = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        toxic = np.asarray(batch.column(1).cast(pa.int64()))
        last = np.zeros(0, np.int64)
        for i, _, goes_on, tokens in _pieces(batch.column(0)):
            row = np.searchsorted(tokens.rows, np.arange(len(tokens.starts)), "right") - 1
            parts = [(row[which] << BITS) | place for which, place in tokens.units()]
            pairs = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            if goes_on:  # of the same text: places counted for its earlier pieces are not counted again
                pairs = np.setdiff1d(pairs, last)
                last = np.union1d(last, pairs)
            else:
                last = pairs
            for k in (0, 1):
                mine = pairs[toxic[i + (pairs >> BITS)] == k] & ((1 << BITS) - 1)
                np.add.at(seen[k], mine, 1)
    place = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(seen[0, place]), pa.array(seen[1, place])], names=["place", "clean", "toxic"])


def _learned(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str,
             sample_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """The drawn rows (text, toxic) and how many labelled ids each class has."""
    one = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
           .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
           .groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other"))
    one = one.withColumnRenamed("id", id_col).where(learn).withColumnRenamed(id_col, "id")
    sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, sample_rows / max(1, sizes.get(1, 0)))).otherwise(min(1.0, sample_rows / max(1, sizes.get(0, 0))))
    drawn = one.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * float(1 << 30)).select("id", "toxic")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # The drawn labels are bounded by the sample; texts are not shuffled.
    return rows.join(F.broadcast(drawn), "id").select("text", "toxic"), sizes


def _log_odds(counts: DataFrame, n_clean: int, n_toxic: int, prior: float, least_z: float) -> DataFrame:
    """Places that the classes hold unlike each other, with their log-odds, from
    the documents of each class that hold them: place, delta.  Of as many places
    as there are, chance takes about one beyond the root of 2 ln(places)."""
    both = n_clean + n_toxic
    total = F.col("clean") + F.col("toxic")
    alpha = total * (prior / both)
    odds = [F.log((F.col(c) + alpha) / F.greatest(n + prior - F.col(c) - alpha, alpha)) for c, n in (("toxic", n_toxic), ("clean", n_clean))]

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * sum(term(seen, row * (n / both)) for c, n in (("clean", n_clean), ("toxic", n_toxic))
                    for seen, row in ((F.col(c), total), (n - F.col(c), both - total)))
    least = max(least_z**2, 2 * math.log(1 << BITS))
    return counts.select("place", (odds[0] - odds[1]).alias("delta"), ratio.alias("ratio")).where(F.col("ratio") >= least).select("place", "delta")


def _scale(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root lambda of sum p * exp(lambda * s) = 1 over the token
    scores of clean text; at most 2 where clean text has no positive token."""
    p = weights / weights.sum()
    if not (values > 0).any() or (p * values).sum() >= 0:
        return 1.0
    lo, hi = 0.0, 2.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if (p * np.exp(mid * values)).sum() < 1:
            lo = mid
        else:
            hi = mid
    return max(lo, 1e-3)


def _curve(evidence: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve over the root of the evidence, by Newton steps with a
    slight pull to zero; classes weigh as they occur."""
    x = np.sqrt(np.concatenate([evidence, evidence]))
    y = np.repeat([0.0, 1.0], len(evidence))
    w = np.concatenate([clean, toxic])
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -30, 30)))
        grad = design @ (w * (y - p)) - 0.1 * beta
        hess = (design * (w * p * (1 - p))) @ design.T + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -5, 5)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, prior: float = PRIOR, least_z: float = LEAST_Z, drift: float = DRIFT) -> Model:
    """Learn from the labelled ids for which ``learn`` (a condition on the id
    column) holds.  The driver gets one row per place of the score table, one
    per distinct score and one per step of evidence at most."""
    spark = docs.sparkSession
    ship_package(spark)
    rows, sizes = _learned(docs, labels, learn, id_col, text_col, label_col, sample_rows)
    rows = written(rows, "toxicity-sample")  # bounded by sample_rows
    known = sum(sizes.values())
    if not known:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    rate = (sizes.get(1, 0) + 0.5) / (known + 1.0)
    found = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = np.zeros(1 << BITS, np.float32)
    if not (found.get(0) and found.get(1)):
        return Model(table, rate)
    counts = (rows.mapInArrow(_count_units, "place long, clean long, toxic long")
              .groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    scored = _log_odds(counts, found[0], found[1], prior, least_z).toPandas()
    table[scored["place"].to_numpy()] = scored["delta"].to_numpy() - drift
    model = Model(table, rate, drift)

    # Token scores of clean rows, and each row's tokens and best segment.
    shared = spark.sparkContext.broadcast(model)

    def clean_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, weights = np.zeros(0), np.zeros(0, np.int64)
        for b in batches:
            for _, _, _, tokens in _pieces(b.column(0)):
                v, w = np.unique(shared.value.token_scores(tokens), return_counts=True)
                values, at = np.unique(np.concatenate([values, v]), return_inverse=True)
                weights = np.bincount(at, np.concatenate([weights, w]), len(values)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(weights)], names=["value", "n"])

    seen = (rows.where("toxic = 0").select("text").mapInArrow(clean_scores, "value double, n long")
            .groupBy("value").agg(F.sum("n").alias("n")).toPandas())
    if len(seen):
        model.scale = _scale(seen["value"].to_numpy(), seen["n"].to_numpy(float))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, found = shared.value.scan(b.column(0))
            top = [max((s for _, _, s in x), default=0.0) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(top, pa.float64())], names=["n", "top"])

    tops = rows.where("toxic = 0").select("text").mapInArrow(best, "n long, top double")
    reach = tops.agg(F.sum(F.col("n") * F.exp(-model.scale * F.col("top")))).first()[0]
    model.density = found[0] / max(reach or 0.0, 1.0)
    shared.unpersist()

    again = spark.sparkContext.broadcast(model)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, found = again.value.scan(b.column(0))
            steps = [min(STEPS, round(again.value.evidence(int(k), x) / STEP)) for k, x in zip(n.tolist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(steps, pa.int64())], names=["toxic", "step"])

    bins = rows.mapInArrow(evidence, "toxic int, step long").groupBy("step").agg(
        F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")).toPandas()
    again.unpersist()
    # Drawn classes weigh as all labelled rows of their class.
    weigh = {k: sizes[k] / found[k] for k in (0, 1)}
    model.curve = _curve(bins["step"].to_numpy() * STEP, bins["clean"].to_numpy() * weigh[0], bins["toxic"].to_numpy() * weigh[1])
    return model


def score_toxicity(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score", predicted_col: str = "predicted",
                   passages_col: str = "passages", expect: float = EXPECT, keep: list[str] | None = None) -> DataFrame:
    """Score every text.  Adds the score, predicted (1 from 0.5 on) and the
    significant passages: start and end in code points (end exclusive), the
    segment's score and how many such segments clean text of that length has."""
    ship_package(docs.sparkSession)
    made = (score_col, predicted_col, passages_col)
    keep = [c for c in docs.columns if c not in made] if keep is None else keep
    text = text_col if text_col in keep else fresh(docs, "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text_col}`").cast("string").alias(text)]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n, found = m.scan(b.column(text))
            score = np.array([m.score(m.evidence(int(k), x)) for k, x in zip(n.tolist(), found, strict=True)])
            passages = [[{"start": s, "end": e, "score": v, "expected": x} for s, e, v in segments
                         if (x := m.density * k * math.exp(-m.scale * v)) <= expect] for k, segments in zip(n.tolist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32)),
                                              pa.array(passages, kind)], names=[*keep, *made])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(run, ", ".join([*kinds, f"`{score_col}` double", f"`{predicted_col}` int",
                                           f"`{passages_col}` array<struct<start: bigint, end: bigint, score: double, expected: double>>"]))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from the fit: crc32 of the id as text, modulo 5, is 0.  A
    null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
