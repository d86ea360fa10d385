import hashlib
import re

import pytest

from lading.llm import decontaminate as D
from tests_llm_prose import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = WORD.findall((text or "").translate(LOW))
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add("" if name is None else str(name))
    out = []
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit.update(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [(1, prose(1, 40)), (2, prose(2, 13)), (3, "short item"), (4, "tau"), (5, None), (6, ""), (7, "!!"), (2, prose(3, 20)), (8, prose(1, 40)), (None, prose(4, 15))]
DOCS = [
    (1, prose(50, 100) + ". " + prose(1, 40).upper()), (2, prose(1, 40)[20:200]), (3, "x short  ITEM y, short-item " + prose(51, 500)), (4, "tau " * 30),
    (5, None), (6, ""), (7, "?!"), (8, prose(2, 13) + " " + prose(2, 13)), (9, prose(52, 3000) + " " + prose(3, 20)), (10, prose(4, 15) + prose(4, 15)),
    (8, prose(2, 13)), (None, prose(1, 40)), (11, "é" + prose(1, 40)),
]


@pytest.mark.parametrize("block", [1 << 20, 1])
def test_matches_brute_force(spark, documents, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find_contamination(documents(DOCS), items, block_bytes=block)
    got = [tuple(r)[:6] for r in D.digest(found).collect()]
    assert sorted(got, key=str) == brute(DOCS, ITEMS)


def test_clean_rows_stay_and_contaminated_go(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(r.doc_id), r.text or "") for r in D.decontaminate(documents(DOCS), items).collect())
    want = sorted((str(i), t or "") for i, t in DOCS if not brute([(i, t)], ITEMS)[0][5])
    assert got == want


def test_longest_match(spark, documents):
    items = spark.createDataFrame([(1, prose(1, 40)), (2, prose(2, 30))], "item_id long, text string")
    text = prose(60, 10) + " " + " ".join(prose(1, 40).split()[5:30]) + " " + prose(2, 30)
    r = D.find_contamination(documents([(1, text)]), items).first()
    assert r.longest.asDict() == {"words": 30, "start": 35, "item": "2", "item_start": 0}
    assert [h.asDict() for h in r.hits] == [{"start": 10, "end": 65}]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_contamination(documents([]), none).collect() == []
    assert [r.contaminated for r in D.find_contamination(documents(DOCS[:1]), none).collect()] == [False]


def longest_brute(text, items):
    """Words, start, item and item start of the longest verbatim match that holds a window."""
    words = WORD.findall(text.translate(LOW))
    best = None
    for name, item in items:
        own = WORD.findall(item.translate(LOW))
        need = min(len(own), D.WINDOW)
        for i in range(len(words)):
            for j in range(len(own)):
                n = 0
                while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                    n += 1
                if need and n >= need and (best is None or (n, -i) > (best[0], -best[1])):
                    best = (n, i)
    return best


@pytest.mark.parametrize("pairs", [1, 7, 1 << 20])
def test_repetitive_texts_match_brute_force(spark, monkeypatch, pairs):
    monkeypatch.setattr(D, "PAIRS", pairs)
    items = [("same", "go " * 30), ("two", "go up " * 12), ("short", "up go"), ("short", "go go go"), ("", "end " + "go " * 14 + "end")]
    texts = ["go " * 50, "up go " * 20, "go " * 14 + "stop " + "go " * 17, "end " + "go " * 14 + "end", "up", "GO go GO", "", "x " * 20, "go " * 12 + "end"]
    q = D.Queries(items)
    data, offsets = D._concat(texts)
    rows = D._rows(data, offsets, q)
    for text, row in zip(texts, rows, strict=True):
        words = WORD.findall(text.translate(LOW))
        hit, found = [False] * len(words), set()
        for name, item in items:
            own = WORD.findall(item.translate(LOW))
            width = min(len(own), D.WINDOW)
            windows = {tuple(own[k: k + width]) for k in range(len(own) - width + 1)}
            for k in range(len(words) - width + 1):
                if tuple(words[k: k + width]) in windows:
                    found.add(name)
                    hit[k: k + width] = [True] * width
        got = [False] * len(words)
        for h in row["hits"]:
            assert not any(got[max(0, h["start"] - 1): h["end"] + 1])  # maximal runs
            got[h["start"]: h["end"]] = [True] * (h["end"] - h["start"])
        assert (got, set(row["items"])) == (hit, found)
        longest = row["longest"] and (row["longest"]["words"], row["longest"]["start"])
        assert longest == longest_brute(text, items)


def test_a_long_text_of_one_word_is_searched_in_linear_time():
    import time

    data, offsets = D._concat(["word " * 200_000, "word"])
    begin = time.perf_counter()
    rows = D._rows(data, offsets, D.Queries([("i", "word " * 120)]))
    assert time.perf_counter() - begin < 10
    assert rows[0]["hits"] == [{"start": 0, "end": 200_000}] and rows[0]["longest"]["words"] == 120 and rows[1]["hits"] == []
