"""Language identification by segmentation-marginalised unigrams.

The pieces come from a fixed public vocabulary (a ``sentencepiece`` model) and
are never trained.  Each language has a probability for every piece; a word's
probability is the sum over all its segmentations into pieces, found by the
forward algorithm, and a text's score is the sum of its words' logs plus the
language's log prior.  The forward recursion runs over all distinct words of a
slice of texts at once, one array step per character.

Piece probabilities are fitted by expectation maximisation (forward-backward
over word counts) on a bounded sample of labelled rows: at most
``SAMPLE_ROWS`` rows a language, taken evenly by a hash of the text.  Expected
counts are summed by Spark; only one number per (language, piece) reaches the
driver.  Everything else covers whole texts.

A text without a letter, empty or null gets ``und`` and score 0.  The score is
the posterior probability of the predicted language after the text's
log-likelihood is divided by ``TEMPER`` characters' worth of evidence, so it
does not saturate on long texts; equal scores go to the first language in
sorted order.  Rows without a label are never learned from.  Without any
labelled row every text is ``und``.  Extra columns are ignored, repeated rows
give repeated results, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.columns import fresh
from lading.session import shared_dir, ship_package

UND = "und"
#: Labelled rows a language that the fit uses at most (the documented bound).
SAMPLE_ROWS = 1_000
#: Passes of expectation maximisation.
EM_ROUNDS = 2
#: Bytes of text scored at once in a task.
SLICE_BYTES = 6 << 20
#: Words times languages whose sums are held at once.
BLOCK_SUMS = 100_000
#: Longer letter runs (scripts without spaces) are scored in parts of this size.
RUN_LETTERS = 250
#: Letters of one part of a letter run in the fit.
FIT_LETTERS = 40
#: Evidence weight: log-likelihood ratios are scaled to this many letters.
TEMPER = 40.0
_FLOOR = 1e-9
_MULT = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary's lower-case letter pieces, found by hash.

    ``find`` maps 64-bit piece hashes to piece numbers, -1 where there is no
    such piece.  A hash is a polynomial over code points, so the hashes of all
    substrings that end at a position follow from those one shorter.
    """

    def __init__(self, vocabulary: str):
        import sentencepiece
        from public_tokenizers import path

        sp = sentencepiece.SentencePieceProcessor(model_file=path(vocabulary))
        found = set()
        for k in range(sp.get_piece_size()):
            if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)):
                text = sp.id_to_piece(k).replace("▁", "").lower()
                if text and text.isalpha():
                    found.add(text)
        self.texts = sorted(found)
        self.longest = max(map(len, self.texts), default=1)
        h = np.zeros(len(self.texts), np.uint64)
        for k, t in enumerate(self.texts):
            x = 0
            for c in t:
                x = (x * int(_MULT) + ord(c)) & 0xFFFFFFFFFFFFFFFF
            h[k] = x
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.slot = np.full(1 << bits, -1, np.int32)
        self.probes = 1
        for k, x in enumerate(h.tolist()):
            at, d = ((x * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF) >> (64 - bits), 1
            while self.slot[at] >= 0:
                at, d = (at + 1) % (1 << bits), d + 1
            self.keys[at], self.slot[at] = x, k
            self.probes = max(self.probes, d)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = ((h * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)
        out = np.where(self.keys[at] == h, self.slot[at], -1)
        for d in range(1, self.probes):
            there = (at + d) & (len(self.slot) - 1)
            out = np.where((out < 0) & (self.keys[there] == h), self.slot[there], out)
        return out


_PIECES: dict[str, Pieces] = {}


def _pieces(vocabulary: str) -> Pieces:
    if vocabulary not in _PIECES:
        _PIECES[vocabulary] = Pieces(vocabulary)
    return _PIECES[vocabulary]


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words by falling length: their order, code points and offsets."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-lengths, kind="stable")
    joined = "".join([words[k] for k in order])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    offsets = np.concatenate([[0], np.cumsum(lengths[order])])
    return order, points, offsets


def _forward(words: list[str], pieces: Pieces, table: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language (languages by words).
    The forward recursion runs over all words at once, one step per character;
    the words still running at a step are a prefix of the length order."""
    order, points, offsets = _code_points(words)
    length = np.diff(offsets)
    n, top, langs = len(words), pieces.longest, len(table)
    ring = np.zeros((top, langs, n))  # ring[(i - l) % top] holds the sums at i - l
    ring[0] = 1.0
    log = np.zeros((langs, n))
    hashes = np.zeros((top + 1, n), np.uint64)
    final = np.zeros((langs, n))
    for i in range(1, int(length[0]) + 1 if n else 1):
        m = int(np.searchsorted(-length, -i, "right"))
        c = points[offsets[:m] + i - 1]
        now = ring[(i - 1) % top, :, :m] * unknown[:, None]  # a letter outside every piece
        for size in range(min(top, i), 0, -1):
            hashes[size, :m] = (hashes[size - 1, :m] if size > 1 else np.uint64(0)) * _MULT + c
            k = pieces.find(hashes[size, :m])
            hit = np.flatnonzero(k >= 0)
            if len(hit):
                now[:, hit] += ring[(i - size) % top][:, hit] * table[:, k[hit]]
        if i % 8 == 0:  # keep the sums in range
            peak = np.maximum(now, ring[:, :, :m].max(axis=0))
            ring[:, :, :m] /= peak
            now = now / peak
            log[:, :m] += np.log(peak)
        ring[i % top, :, :m] = now
        done = slice(int(np.searchsorted(-length, -i - 1, "right")), m)
        final[:, done] = np.log(now[:, done]) + log[:, done]
    out = np.zeros((langs, n))
    out[:, order] = final
    return out


def _expected(words: list[str], counts: np.ndarray, lang: np.ndarray, pieces: Pieces, table: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Expected piece counts (languages by pieces) of counted words under the
    present probabilities; word k belongs to language lang[k].  Words are
    bounded in length by the caller, so plain sums stay in range."""
    order, points, offsets = _code_points(words)
    length, n = np.diff(offsets), len(words)
    lg, weight = lang[order], counts[order].astype(float)
    width = int(length[0]) if n else 0
    alpha, beta = np.zeros((width + 1, n)), np.zeros((width + 1, n))
    alpha[0] = 1.0
    hashes = np.zeros((pieces.longest + 1, n), np.uint64)
    arcs = []
    for i in range(1, width + 1):
        m = int(np.searchsorted(-length, -i, "right"))
        c = points[offsets[:m] + i - 1]
        alpha[i, :m] = alpha[i - 1, :m] * unknown[lg[:m]]
        for size in range(min(pieces.longest, i), 0, -1):
            hashes[size, :m] = (hashes[size - 1, :m] if size > 1 else np.uint64(0)) * _MULT + c
            k = pieces.find(hashes[size, :m])
            hit = np.flatnonzero(k >= 0)
            if len(hit):
                arcs.append((i, size, hit, k[hit]))
                alpha[i, hit] += alpha[i - size, hit] * table[lg[hit], k[hit]]
    beta[length, np.arange(n)] = 1.0
    total = alpha[length, np.arange(n)]
    sums = np.zeros((len(table), table.shape[1]))
    at = len(arcs) - 1
    for i in range(width, 0, -1):
        m = int(np.searchsorted(-length, -i, "right"))
        while at >= 0 and arcs[at][0] == i:
            _, size, hit, k = arcs[at]
            flow = table[lg[hit], k] * beta[i, hit]
            beta[i - size, hit] += flow
            np.add.at(sums, (lg[hit], k), weight[hit] * alpha[i - size, hit] * flow / total[hit])
            at -= 1
        beta[i - 1, :m] += beta[i, :m] * unknown[lg[:m]]
    return sums


def _letter_words(texts: pa.Array):
    """Lower-case letter runs of each text, as a list array."""
    import pyarrow.compute as pc

    words = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+")
    if (pc.max(pc.utf8_length(words.values)).as_py() or 0) > RUN_LETTERS:
        cut = pc.replace_substring_regex(pc.utf8_lower(texts), rf"([\p{{L}}\p{{M}}]{{{RUN_LETTERS}}})", r"\1 ")
        words = pc.split_pattern_regex(cut, r"[^\p{L}\p{M}]+")
    return words


class Model:
    """Languages, log priors and piece probabilities (bounded by the number of
    languages times the vocabulary)."""

    def __init__(self, vocabulary: str, languages: list[str], priors: list[float], table: np.ndarray):
        self.vocabulary, self.languages, self.priors, self.table = vocabulary, languages, priors, table
        self.unknown = np.full(len(languages), _FLOOR)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        import pyarrow.compute as pc

        texts = texts.fill_null("")
        pieces = _pieces(self.vocabulary)
        lengths = np.asarray(pc.binary_length(texts), np.int64)
        cum = np.concatenate([[0], np.cumsum(lengths)])
        labels: list[str] = []
        score = np.zeros(len(texts))
        if not self.languages:
            return [UND] * len(texts), score
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(cum, cum[i] + SLICE_BYTES, "right")) - 1)
            part = texts.slice(i, j - i)
            words = _letter_words(part)
            offsets = np.asarray(words.offsets, np.int64)
            coded = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            vocab = coded.dictionary.to_pylist()
            block = max(1_000, BLOCK_SUMS // len(self.languages))
            logs = np.concatenate([np.zeros((len(self.languages), 0))] + [
                _forward(vocab[k: k + block], pieces, self.table, self.unknown) for k in range(0, len(vocab), block)], axis=1)
            index = np.asarray(coded.indices) if len(coded) else np.zeros(0, np.int64)
            letters = np.array([len(w) for w in vocab], np.int64)
            starts = offsets - offsets[0]
            n = np.diff(np.concatenate([[0], np.cumsum(letters[index])])[starts]) if vocab else np.zeros(j - i, np.int64)
            total = np.stack([np.diff(np.concatenate([[0.0], np.cumsum(row[index])])[starts]) for row in logs]) if vocab else np.zeros((len(self.languages), j - i))
            has = np.asarray(pc.match_substring_regex(part, r"\p{L}"))
            pick = (total + np.asarray(self.priors)[:, None]).argmax(axis=0)
            x = (total - total.max(axis=0)) * np.minimum(1.0, TEMPER / np.maximum(n, 1)) + np.asarray(self.priors)[:, None]
            p = np.exp(x - x.max(axis=0))
            p /= p.sum(axis=0)
            score[i:j] = np.where(has, p[pick, np.arange(j - i)], 0.0)
            labels += [self.languages[k] if h else UND for k, h in zip(pick.tolist(), has.tolist(), strict=True)]
            i = j
        return labels, score


def fit(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        vocabulary: str = "piece_bpe_32k.model", sample_rows: int = SAMPLE_ROWS, rounds: int = EM_ROUNDS) -> Model:
    """Fit piece probabilities on the rows where ``learn`` holds and the label
    is known; ``sample_rows`` rows a language are used in the mean where there
    are more, drawn by a hash of id and text."""
    spark = docs.sparkSession
    ship_package(spark)
    shared_dir(spark)
    labelled = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(text_col, id_col).alias("draw"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model(vocabulary, [], [], np.zeros((0, 1)))
    whole = sum(sizes.values())
    priors = [float(np.log((sizes[k] + 1) / (whole + len(languages)))) for k in languages]
    share = F.element_at(F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample_rows / sizes[k])))]), F.col("lang"))
    drawn = labelled.where(F.pmod("draw", F.lit(1 << 30)) < share * float(1 << 30))
    # Letter runs are counted whole, longer ones in successive parts (a run without
    # spaces may be a sentence); piece boundaries at the cuts are few.
    runs = F.regexp_extract_all(F.lower("text"), F.lit(rf"[\p{{L}}\p{{M}}]{{1,{FIT_LETTERS}}}"), F.lit(0))
    words = (drawn.select("lang", F.explode(runs).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    words = words.checkpoint()
    place = {k: i for i, k in enumerate(languages)}
    size = len(_pieces(vocabulary).texts)
    table = np.full((len(languages), size), 1.0 / size)
    unknown = np.full(len(languages), _FLOOR)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((table, unknown, place))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table, unknown, place = shared.value
            for b in batches:
                lang = np.array([place[k] for k in b.column(0).to_pylist()], np.int64)
                sums = _expected(b.column(1).to_pylist(), np.asarray(b.column(2)), lang, _pieces(vocabulary), table, unknown)
                row, col = np.nonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(col), pa.array(sums[row, col])], names=["lang", "piece", "n"])

        counts = words.mapInArrow(expect, "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        got = np.full((len(languages), size), 0.01)
        got[counts["lang"].to_numpy(), counts["piece"].to_numpy()] += counts["n"].to_numpy()
        table = got / got.sum(axis=1, keepdims=True)
        shared.unpersist()
    return Model(vocabulary, languages, priors, table)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score",
             keep: list[str] | None = None) -> DataFrame:
    """Predict every text; ``keep`` names the input columns to carry (all but
    clashing ones by default)."""
    ship_package(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (pred_col, score_col)] if keep is None else keep
    text = text_col if text_col in keep else fresh(docs, "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text_col}`").cast("string").alias(text)]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, score = shared.value.predict(b.column(text))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(labels, pa.string()), pa.array(score)],
                                             names=[*keep, pred_col, score_col])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(predict, ", ".join([*kinds, f"`{pred_col}` string", f"`{score_col}` double"]))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from the fit: crc32 of the id as text, modulo 4, is 2.  A
    null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
