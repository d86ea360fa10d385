"""Benchmark decontamination with suffix arrays over the training documents.

Documents are read in shards (slices of an Arrow batch).  For each shard a
task builds a suffix array of the word positions that can begin a match, each
suffix compared on its first ``WINDOW`` words, and binary-searches every
benchmark suffix in it, equal ones once.  The range found gives all verbatim
occurrences and their places; runs along a diagonal give the longest match.  A
window longer than ``WINDOW`` words is a run of windows, so no depth is lost.  Of
the pairs (place in the text, place in an item) only those that begin or end a run
are kept, and they are looked at ``PAIRS`` at a time, so a text that repeats
itself against an item that does needs no more memory than others.

The benchmark is the stated query set.  It travels to the tasks in blocks of
at most ``BLOCK_BYTES`` of text, one broadcast a block; results of later blocks
join those of earlier ones row by row.

Words are maximal runs of bytes outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after lower-casing A-Z.  An item of fewer words than a window is one window;
an item without words has none.  Null and empty texts have no words and are
never contaminated; a null item id is written as the empty string.  Repeated
rows give repeated results, repeated item ids count once, extra columns are
ignored, and empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm import bytetext as B
from lading.llm.columns import fresh
from lading.session import ship_package

WINDOW = 13
#: Benchmark text in one broadcast block.
BLOCK_BYTES = 8 << 20
#: Pairs of places looked at together.
PAIRS = 1 << 20


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[lo: hi + 1] = True
    return table


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and each text's first word."""
    starts, ends, first = B.word_bounds(data, offsets, _word_bytes())
    return B.span_hashes(data, starts, ends, B.lower_ascii()), first


def _keys(ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Fixed-width byte keys of the suffixes of ``ids`` at ``at``, cut to
    ``length`` words (at most WINDOW) and padded with zeros: their byte order
    is the suffix order."""
    step = np.arange(WINDOW)
    where = at[:, None] + step
    words = ids[np.minimum(where, max(len(ids) - 1, 0))] if len(ids) else np.zeros((len(at), WINDOW), ids.dtype)
    words = np.where(step < length[:, None], words, 0).astype(">u4")
    return np.ascontiguousarray(words).view(f"S{4 * WINDOW}").ravel()


class Queries:
    """The windows of one benchmark block, ready to be searched for."""

    def __init__(self, items: list[tuple[str, str]]):
        self.names = sorted({name for name, _ in items})
        place = {name: k for k, name in enumerate(self.names)}
        hashes, first = _words(*_concat([text for _, text in items]))
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        count = np.diff(first)
        width = np.minimum(count, WINDOW)
        n = np.where(count > 0, count - width + 1, 0)  # windows of each item
        owner = np.repeat(np.arange(len(items)), n)
        self.at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)  # word place in the item
        start = first[:-1][owner] + self.at
        self.width = width[owner]
        self.source = owner  # row of the benchmark: repeated ids stay apart
        self.item = np.array([place[name] for name, _ in items], np.int64)[owner] if len(items) else np.zeros(0, np.int64)
        #: A run of windows begins at an item's first, ends at its last.
        self.first, self.last = self.at == 0, self.at == np.repeat(n, n) - 1
        self.before = np.append(ids, 0)[start - 1] if len(start) else start
        self.after = np.append(ids, 0)[np.minimum(start + self.width, len(ids))] if len(start) else start
        # Equal windows are searched once: group g is windows[of[g]:of[g + 1]].
        low = _keys(ids, start, self.width)
        self.windows = np.argsort(low, kind="stable")
        self.low, begin = np.unique(low[self.windows], return_index=True)
        self.of = np.append(begin, len(low))
        self.group_width = self.width[self.windows[begin]] if len(low) else np.zeros(0, np.int64)
        high = np.frombuffer(self.low.tobytes().ljust(self.low.nbytes, b"\0"), np.uint8).reshape(len(self.low), 4 * WINDOW).copy() if len(start) else np.zeros((0, 4 * WINDOW), np.uint8)
        high[np.arange(4 * WINDOW) >= 4 * self.group_width[:, None]] = 255
        self.high = high.view(f"S{4 * WINDOW}").ravel()
        #: Shortest window that begins with a word; a training suffix with a
        #: shorter run of benchmark words cannot match.
        self.need = np.full(len(self.vocabulary) + 1, np.iinfo(np.int64).max)
        np.minimum.at(self.need, ids[start] if len(start) else np.zeros(0, np.int64), self.width)


def _concat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def suffix_array(ids: np.ndarray, first: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a shard's word ids (0: not a benchmark word) over the
    positions whose run of benchmark words inside their text is long enough
    to match.  Returns positions in suffix order and their keys."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, f"S{4 * WINDOW}")
    stop = np.where(ids == 0, np.arange(n), n)
    inner = first[(first > 0) & (first < n)]
    end = np.minimum.accumulate(stop[::-1])[::-1]
    text_end = np.append(inner, n)[np.searchsorted(inner, np.arange(n), "right")]
    run = np.minimum(end, text_end) - np.arange(n)
    at = np.flatnonzero(run >= np.where(ids > 0, need[ids], n + 1))
    keys = _keys(ids, at, np.minimum(run[at], WINDOW))
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def search_shard(data: np.ndarray, offsets: np.ndarray, q: Queries) -> tuple[np.ndarray, ...]:
    """All occurrences of q's distinct windows in a shard: word positions, window
    groups, the shard's first-word index per text, and its word ids."""
    hashes, first = _words(data, offsets)
    if len(hashes) == 0 or len(q.low) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, first, empty
    found = np.searchsorted(q.vocabulary, hashes)
    found[found == len(q.vocabulary)] = 0
    ids = np.where(q.vocabulary[found] == hashes, found + 1, 0)
    sa, keys = suffix_array(ids, first, q.need)
    lo, hi = np.searchsorted(keys, q.low, "left"), np.searchsorted(keys, q.high, "right")
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return sa[rank], which, first, ids


def _run_ends(at: np.ndarray, which: np.ndarray, first: np.ndarray, ids: np.ndarray, q: Queries) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs (word position, query window) that begin, and that end, a run of
    windows along a diagonal: the words before (after) differ, or one side ends."""
    texts_begin = np.zeros(len(ids) + 1, bool)
    texts_begin[first] = True
    padded = np.append(ids, 0)
    size = np.diff(q.of)[which]
    cum = np.concatenate([[0], np.cumsum(size)])
    begins: list[list[np.ndarray]] = [[], []]
    ends: list[list[np.ndarray]] = [[], []]
    for k in range(0, int(cum[-1]), PAIRS):
        pair = np.arange(k, min(k + PAIRS, int(cum[-1])))
        occurrence = np.searchsorted(cum, pair, "right") - 1
        window = q.windows[q.of[which[occurrence]] + pair - cum[occurrence]]
        place = at[occurrence]
        stop = place + q.width[window]
        opens = q.first[window] | texts_begin[place] | (padded[place - 1] != q.before[window])
        closes = q.last[window] | texts_begin[stop] | (padded[stop] != q.after[window])
        for out, mask in ((begins, opens), (ends, closes)):
            out[0].append(place[mask])
            out[1].append(window[mask])
    return [np.concatenate(x) for x in begins], [np.concatenate(x) for x in ends]


def _rows(data: np.ndarray, offsets: np.ndarray, q: Queries) -> list[dict]:
    """Per text: n_words, hit runs, items and the longest match."""
    at, which, first, ids = search_shard(data, offsets, q)
    texts = len(offsets) - 1
    rows = [{"n_words": int(n), "hits": [], "items": [], "longest": None} for n in np.diff(first)]
    if len(at) == 0:
        return rows
    # covered words, as maximal runs inside a text
    mark = np.zeros(first[-1] + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + q.group_width[which], -1)
    hit = np.concatenate([[False], np.cumsum(mark)[:-1] > 0, [False]])
    cut = np.zeros(first[-1] + 1, bool)
    cut[first] = True
    starts = np.flatnonzero(hit[1:-1] & (~hit[:-2] | cut[:-1]))
    stops = np.flatnonzero(hit[1:-1] & (~hit[2:] | cut[1:])) + 1
    owner = np.searchsorted(first, starts, "right") - 1
    for d, s, e in zip(owner.tolist(), (starts - first[owner]).tolist(), (stops - first[owner]).tolist(), strict=True):
        rows[d]["hits"].append({"start": s, "end": e})
    # items: each distinct window of a text brings all items that hold it
    doc = np.searchsorted(first, at, "right") - 1
    met = np.unique(doc * len(q.low) + which)
    group = met % len(q.low)
    size = q.of[group + 1] - q.of[group]
    window = q.windows[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(q.of[group], size)]
    pair = np.unique(np.repeat(met // len(q.low), size) * len(q.names) + q.item[window])
    for p in pair.tolist():
        rows[p // len(q.names)]["items"].append(q.names[p % len(q.names)])
    # longest verbatim match: on a diagonal, beginnings and ends of runs alternate
    (a, wa), (b, wb) = _run_ends(at, which, first, ids, q)
    text = np.searchsorted(first, a, "right") - 1
    diagonal = a - q.at[wa]
    order = np.lexsort((a, diagonal, q.source[wa], q.item[wa], text))
    finish = np.lexsort((b, b - q.at[wb], q.source[wb], q.item[wb], np.searchsorted(first, b, "right") - 1))
    a, wa, text, diagonal = a[order], wa[order], text[order], diagonal[order]
    length = b[finish] + q.width[wb[finish]] - a
    best = np.lexsort((diagonal, q.item[wa], a, -length, text))  # a text's longest first, of equals the earliest
    best = best[np.concatenate([[True], np.diff(text[best]) > 0])]
    for k in best.tolist():
        d, w = int(text[k]), int(wa[k])
        rows[d]["longest"] = {"words": int(length[k]), "start": int(a[k] - first[d]), "item": q.names[int(q.item[w])], "item_start": int(q.at[w])}
    return rows


_LONGEST = pa.struct([("words", pa.int64()), ("start", pa.int64()), ("item", pa.string()), ("item_start", pa.int64())])
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = {"n_words": "long", "hits": "array<struct<start:long,end:long>>", "items": "array<string>",
          "longest": "struct<words:long,start:long,item:string,item_start:long>"}


def _joined(old: dict, new: dict) -> dict:
    """Results of one text from two blocks."""
    runs: list[dict] = []
    for h in sorted(old["hits"] + new["hits"], key=lambda h: h["start"]):
        if runs and h["start"] <= runs[-1]["end"]:
            runs[-1]["end"] = max(runs[-1]["end"], h["end"])
        else:
            runs.append(dict(h))
    longest = max((x["longest"] for x in (old, new) if x["longest"]), key=lambda x: (x["words"], -x["start"]), default=None)
    return {"n_words": new["n_words"], "hits": runs, "items": sorted({*old["items"], *new["items"]}), "longest": longest}


def _search_block(rows: DataFrame, block: list[tuple[str, str]], text: str, names: dict[str, str], again: bool) -> DataFrame:
    """``rows`` with the results columns (``names``: result to column);
    ``again``: they hold results of earlier blocks, which are joined."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    own = list(names.values())
    carried = [c for c in rows.columns if c not in own]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Queries(shared.value)
        for b in batches:
            for i, j, data, offsets in B.byte_slices(b.column(text)):
                found = _rows(data, offsets, q)
                B.release(len(data))
                if again:
                    old = b.slice(i, j - i).select(own).to_pylist()
                    found = [_joined({k: o[c] for k, c in names.items()}, f) for o, f in zip(old, found, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    *[b.column(c).slice(i, j - i) for c in carried],
                    pa.array([r["n_words"] for r in found], pa.int64()),
                    pa.array([r["hits"] for r in found], _HITS),
                    pa.array([r["items"] for r in found], pa.list_(pa.string())),
                    pa.array([r["longest"] for r in found], _LONGEST)],
                    names=[*carried, *own])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried] + [f"`{c}` {_FOUND[k]}" for k, c in names.items()]
    return rows.mapInArrow(search, ", ".join(kinds))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of about ``block_bytes``; one at least."""
    block: list[tuple[str, str]] = []
    size = 0
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("k"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    for r in items.toLocalIterator():
        if size > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["k"], r["t"]))
        size += len(r["t"])
    yield block


def search(docs: DataFrame, benchmark: DataFrame, *, keep: list[str], text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` of docs and the results; also returns the names of
    the result columns: n_words, hits (maximal runs of hit words, end
    exclusive), items (item ids found, as sorted strings), longest (words,
    place and item of the longest verbatim match), and n_hit, contaminated."""
    ship_package(docs.sparkSession)
    names = {k: fresh(docs, k) for k in _FOUND}
    text = text_col if text_col in keep else fresh(docs, "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text in keep else [F.col(f"`{text_col}`").cast("string").alias(text)]))
    for n, block in enumerate(_blocks(benchmark, item_col, item_text_col, block_bytes)):
        rows = _search_block(rows, block, text, names, n > 0)
    n_hit, contaminated = fresh(docs, "n_hit"), fresh(docs, "contaminated")
    hit = F.aggregate(names["hits"], F.lit(0).cast("long"), lambda acc, h: acc + h["end"] - h["start"])
    rows = rows.withColumn(n_hit, hit).withColumn(contaminated, (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(names["n_words"])))
    return rows.select(*[F.col(f"`{c}`") for c in keep], *names.values(), n_hit, contaminated), names | {"n_hit": n_hit, "contaminated": contaminated}


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: the id, n_words, hits, items, longest, n_hit,
    contaminated (at least a twentieth of the words is hit)."""
    found, names = search(docs, benchmark, keep=[id_col], **options)
    return found.select(id_col, *[F.col(c).alias(k) for k, c in names.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows, in one pass over the texts."""
    found, names = search(docs, benchmark, keep=docs.columns, **options)
    return found.where(~F.col(names["contaminated"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated", F.col("longest.words").alias("longest_words"), F.col("longest.start").alias("longest_start"),
        F.col("longest.item").alias("longest_item"))
