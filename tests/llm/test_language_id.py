import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lading.llm import language_id as L

EN = "the cat and the dog were in the house with that other thing which they should have seen"
DE = "der hund und die katze waren in dem haus mit der sache die sie nicht gesehen haben und auch das"


def segmentations(word, probs, unknown):
    """Sum over all segmentations, by listing them."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        places = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
        p = 1.0
        for a, b in itertools.pairwise(places):
            # a single letter has two readings: as a piece and as an unknown letter
            p *= probs.get(word[a:b], 0.0) + (unknown if b - a == 1 else 0.0)
        total += p
    return total


def test_forward_sums_all_segmentations():
    pieces = L._pieces("piece_bpe_32k.model")
    r = np.random.default_rng(0)
    table = r.random((2, len(pieces.texts)))
    table /= table.sum(axis=1, keepdims=True)
    words = ["the", "house", "zug", "ücße", "a", "", "zzzz", "straße"]
    got = L._forward(words, pieces, table, np.full(2, 1e-9))
    for lang in range(2):
        probs = dict(zip(pieces.texts, table[lang], strict=True))
        for k, w in enumerate(words):
            want = np.log(segmentations(w, probs, 1e-9)) if w else 0.0
            assert abs(got[lang, k] - want) < 1e-9


def test_long_runs_stay_in_range():
    model = L.Model("piece_bpe_32k.model", ["a", "b"], [0.0, 0.0], np.full((2, len(L._pieces("piece_bpe_32k.model").texts)), 1e-5))
    labels, score = model.predict(pa.array(["x" * 30_000, "漢" * 5_000]))
    assert np.isfinite(score).all() and labels == ["a", "a"]


def test_learns_and_rejects(spark):
    rows = [(k, " ".join(EN.split()[k % 5:]), "en", "s") for k in range(40)] + [(100 + k, " ".join(DE.split()[k % 5:]), "de", "s") for k in range(40)]
    rows += [(200, None, "en", "s"), (201, "", "de", "s"), (202, "123 !!", "en", "s"), (203, DE.upper(), None, None), (None, EN, "en", None), (203, DE, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = L.fit(docs, ~L.held_out())
    assert model.languages == ["de", "en"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.identify(docs, model, keep=["doc_id"]).collect()]
    for i, pred, score in got:
        want = "und" if i in (200, 201, 202) else "en" if i is None or i < 100 else "de"
        assert (pred, 0 <= score <= 1) == (want, True)
    assert len(got) == len(rows)


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True))
    assert [tuple(r) for r in L.identify(docs, model, keep=["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert L.identify(docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = L.identify(docs, L.fit(docs, ~L.held_out())).where(L.held_out() & F.col("lang").isNotNull())
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 20 and right >= 0.98


def test_a_long_letter_run_is_learned_to_its_end(spark):
    rows = [(k, "q" * 40 + ("zebra" if k % 2 else "monkey") * 30, "za" if k % 2 else "mo") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True))
    asked = spark.createDataFrame([(1, "zebra zebra"), (2, "monkey monkey")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["lang_pred"]) for r in L.identify(asked, model).collect()) == [(1, "za"), (2, "mo")]
