import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests_llm_prose import SF_SMALL

from lading.llm import toxicity as T

DOCS = "doc_id long, text string, score string, passages string, whole_text string"
BAD = ["zounds", "knave", "varlet"]


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        bad = i % 4 == 0
        if bad:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(BAD) for _ in range(4)]
        docs.append((i, " ".join(text), "x", "x", "x"))
        labels.append((i, int(bad)))
    return docs, labels


def test_maximal_segments_equal_the_definition():
    """A segment is maximal if all its proper parts score less and no larger
    segment with that property holds it; found here by trying all."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        score = rng.integers(-6, 7, rng.integers(0, 14)).astype(float)
        total = np.concatenate([[0.0], np.cumsum(score)])

        def good(i, j, total=total):
            own = total[j] - total[i]
            return own > 0 and all(total[b] - total[a] < own for a in range(i, j) for b in range(a + 1, j + 1) if (a, b) != (i, j))

        n = len(score)
        some = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if good(i, j)]
        want = [s for s in some if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in some)]
        plus = np.flatnonzero(score > 0)
        got = [(plus[a], plus[b] + 1) for a, b in T.maximal_segments(total[plus], total[plus + 1])]
        assert got == want


def test_learns_and_finds_the_passage(spark):
    docs, labels = corpus()
    table = spark.createDataFrame(docs, DOCS)
    model = T.fit(table, spark.createDataFrame(labels, "doc_id long, toxic int"), ~T.held_out())
    rows = T.score_toxicity(table, model).withColumn("held", T.held_out()).collect()
    held = [r for r in rows if r.held]
    assert len(held) > 40 and all((r.doc_id % 4 == 0) == r.predicted == (r.score >= 0.5) for r in held)
    for r in held:
        assert bool(r.passages) == (r.doc_id % 4 == 0)
        for p in r.passages:  # a neighbour may score by chance
            words = r.text[p.start:p.end].split()
            assert sum(w in BAD for w in words) == 4 and len(words) <= 6


def test_words_a_little_commoner_in_toxic_texts_are_no_evidence(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(2000):
        bad = i % 4 == 0
        text = [w for w, share in (("topic", 0.4 + 0.2 * bad), ("other", 0.5), (BAD[0], 0.9 * bad)) if rng.random() < share]
        docs.append((i, " ".join(text), "x", "x", "x"))
        labels.append((i, int(bad)))
    model = T.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    score = model.token_scores(T.Tokens(np.frombuffer(b"topic other zounds", np.uint8), np.array([0, 18])))
    assert score[0] < 0 and score[1] == -model.drift and score[2] > 3


@pytest.mark.parametrize("rows", [[], [(1, 1), (2, 1)], [(1, None)], [(1, 0), (1, 1)]])
def test_few_labels(spark, rows):
    table = spark.createDataFrame([(1, "a b c", "x", "x", "x"), (2, "", "x", "x", "x"), (3, None, "x", "x", "x")], DOCS)
    model = T.fit(table, spark.createDataFrame(rows, "doc_id long, toxic int"), F.lit(True))
    got = T.score_toxicity(table, model).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)


def test_a_long_text_scores_as_its_scan_in_one_piece(spark, monkeypatch):
    rng = random.Random(6)
    docs, labels = corpus()
    model = T.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    words = ["élan", "zounds", "varlets", "abc", "über", "knave", "x" * 90]
    texts = pa.array([" ".join(rng.choice(words) for _ in range(3000)), "Zounds, KNAVE", None, "", "é" * 500])
    whole = model.scan(texts)
    monkeypatch.setattr(T, "PIECE_BYTES", 1000)
    parts = model.scan(texts)
    assert whole[0][:4].tolist() == parts[0][:4].tolist()
    assert [[s[:2] for s in x] for x in whole[1]] == [[s[:2] for s in x] for x in parts[1]]
    assert np.allclose([s[2] for x in whole[1] for s in x], [s[2] for x in parts[1] for s in x])


def test_held_out_accuracy_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('sf0.001', 'sf0.01')}/labels.parquet")
    model = T.fit(docs, labels, ~T.held_out())
    rows = T.score_toxicity(docs, model, keep=["doc_id"]).where(T.held_out()).join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert T.score_toxicity(docs.limit(0), model).collect() == []
