import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lading.llm import suffix_dedup as S
from lading.llm.suffix_groups import suffix_array
from tests_llm_prose import prose


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_matches_sorting(symbols):
    want = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert suffix_array(np.array(symbols, np.int64)).tolist() == want


def brute(rows, length):
    """By the definition, over distinct (id, text) in corpus order; ids are unique here."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if raw[k:k + length] in seen:
                gone[k:k + length] = b"\1" * length
            seen.add(raw[k:k + length])
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(df).collect()}


def corpus():
    passage = prose(900, 40)
    rows = [(k, prose(k, 60)) for k in range(10)]
    rows += [(20 + k, prose(30 + k, 10 + k) + passage + prose(60 + k, 8)) for k in range(12)]
    rows += [(40 + k, rows[k][1]) for k in range(4)] + [(50 + k, rows[k][1][:150] + "EDIT" + rows[k][1][154:]) for k in range(6)]
    rows += [(70, None), (71, ""), (72, "short"), (73, "=" * 1000), (74, "ab" * 700), (75, "é漢" * 300), (76, prose(5, 30) * 4), (77, "x" * 99), (78, "x" * 99), (79, "y" * 100), (80, "y" * 100)]
    rows += [(90, "QUJD" * 2 + prose(8, 3).replace(" ", "") * 9), (91, prose(8, 3).replace(" ", "") * 9)]
    return rows


@pytest.mark.parametrize(("heavy", "shard"), [(0.01, 2 << 20), (1e9, 2 << 20), (0.01, 500)])
def test_matches_the_definition(spark, documents, monkeypatch, heavy, shard):
    monkeypatch.setattr(S, "ROOT_PART", heavy)
    monkeypatch.setattr(S, "SHARD_BYTES", shard)
    rows = corpus()
    assert result(S.remove_repeats(documents(rows))) == brute(rows, 100)


def test_other_lengths_and_spans(spark, documents):
    rows = [(1, "0123456789abcdef" * 3), (2, "xx0123456789abcdefyy0123456789abcd")]
    df = S.remove_repeats(documents(rows), length=16, gram=8)
    assert result(df) == brute(rows, 16)
    assert [[s.asDict() for s in r.spans] for r in df.where("doc_id = 2").collect()] == [[{"start": 2, "end": 18}]]


def test_repeated_and_missing_ids(spark, documents):
    text, other = prose(1, 50), prose(2, 50)
    got = S.digest(S.remove_repeats(documents([(1, text), (1, text), (1, other), (None, text), (2, other), (None, None)]))).collect()
    removed = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in got)
    n, m = len(text), len(other)
    # rows equal in id and text are one document; a missing id comes last
    assert removed == sorted([("1", n, 0), ("1", n, 0), ("1", m, 0), ("2", m, m), ("None", n, n), ("None", 0, 0)])


@pytest.mark.parametrize("own", [None, 7])
def test_thousands_of_texts_without_an_id_of_their_own(spark, documents, own):
    passages = [prose(5000 + k, 30) for k in range(40)]
    texts = [prose(k, 12) + (passages[k % 40] if k % 3 == 0 else "") + prose(9000 + k, 12) for k in range(4000)]
    docs = documents([(own, t) for t in texts]).select("doc_id", "text")
    order = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    want = sorted(brute([(order[t], t) for t in texts], 100).values())
    got = S.digest(S.remove_repeats(docs)).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_empty_table(documents):
    assert S.remove_repeats(documents([])).collect() == []
