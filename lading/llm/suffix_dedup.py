"""Removal of long byte strings that occur earlier in the corpus.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier
(smaller id, or same document and smaller start).  Strings are judged on the
input, overlapping ones included, and never cross documents.

1. Anchors.  Every window of LENGTH bytes selects the anchor gram in it whose
   hash is least (leftmost on ties), a choice that depends on the window alone.
   Consecutive windows with one anchor make one record: equal windows lie in
   records of the same anchor at the same place.
2. Records with equal anchor and equal bytes are repeats of the earliest as a
   whole.  They are reduced within each slice of text before the shuffle.
3. Anchors that remain with several contexts (edges of passages, edits in near
   copies) go to shards by anchor.  A shard drops blocks of windows whose common
   bytes no other record has, concatenates the rest of its records, parsed
   into phrases at byte pairs chosen by a hash, builds the suffix array of the
   phrase ranks by suffix grouping (``suffix_groups``), and compares neighbours
   byte by byte.  The windows that begin ``a`` bytes before a phrase are equal
   where their suffixes share LENGTH - a bytes and the ``a`` bytes before
   agree; all but the earliest of them go.
4. Anchors with very many contexts (found by a count over the whole corpus)
   would make one large shard.  Their
   records are dealt over salts, and their windows are compared whole, by a
   128-bit hash, reduced within each slice before the shuffle.

Null and empty texts have no bytes.  Rows that repeat an id and a text are one
document and get one result; other rows that share an id, or have none, are
documents in the order of a 64-bit hash of their text (rows without an id come
last).  The hash is a key column of its own beside the id.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lading.llm import bytetext as B
from lading.llm.graph import written
from lading.llm.suffix_groups import suffix_array
from lading.session import ship_package

LENGTH = 100
GRAM = 24
#: An anchor is frequent if its contexts number at least the square root of all
#: records over ROOT_PART: neither the largest shard nor the list of frequent
#: anchors then grows faster than that root.  The list is cut at HEAVY.
ROOT_PART, HEAVY = 9, 1_000_000
SALTS = 64
#: Bytes of text hashed at once (its arrays fit a core's cache), and bytes of
#: text whose records are reduced together before a shuffle.
SLICE_BYTES, GROUP_BYTES = 1 << 17, 8 << 20
#: Bytes of records that a shard's suffix array is built over at once.
SHARD_BYTES = 2 << 20
#: Windows a block, when a shard looks for what may repeat.
BLOCK = 8
#: A byte pair begins a phrase if its hash falls into one of PHRASE.
PHRASE = 10

_U = np.uint64
_AS_IS = np.arange(256, dtype=np.uint8)
_START = 7  # bits of a packed place below the start: windows after the first
_LAST = (1 << 63) - 1
_HIGH = _U(0xFFFFFFFF00000000)


def _second_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash independent of ``span_hashes``."""
    return B.span_hashes(data, starts, ends, ((_AS_IS.astype(np.int64) * 89 + 41) % 256).astype(np.uint8))


# --- records -----------------------------------------------------------------

def _gram_hashes(total: np.ndarray, down: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at every place."""
    g = total[gram:] - total[:-gram]
    g *= down[: len(g)]
    return B.mix64(g)


def records(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Records of a slice: text, first window, windows after it, anchor hash
    and hash of the bytes its windows cover."""
    n = len(data)
    if n < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(_U), empty.astype(_U)
    total, down = B.running_hash(data, _AS_IS)
    g = _gram_hashes(total, down, gram)
    # 32 bits of the hash above the place: the least is the leftmost least
    best = g & _HIGH
    best |= np.arange(len(g), dtype=_U)
    width, span = 1, length - gram + 1
    while 2 * width <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[: len(best) - (span - width)], best[span - width:])
    change = np.ones(len(best), bool)
    np.not_equal(best[1:], best[:-1], out=change[1:])
    # windows may not cross texts: cut runs there
    edges = offsets[1:-1]
    cross = np.zeros(len(best) + 1, np.int32)
    np.add.at(cross, np.maximum(edges - length + 1, 0).clip(max=len(best)), 1)
    np.add.at(cross, edges.clip(max=len(best)), -1)
    inside = np.cumsum(cross[:-1]) == 0
    change[edges[edges < len(best)]] = True
    first = np.flatnonzero(change & inside)
    stops = np.append(np.flatnonzero(change | ~inside), len(best))
    last = stops[np.searchsorted(stops, first, "right")] - 1
    text = np.searchsorted(offsets, first, "right") - 1
    cover = B.mix64((total[last + length] - total[first]) * down[first] + (last - first).astype(_U))
    return text, first, last - first, g[(best[first] & ~_HIGH).astype(np.int64)], cover


def merge_spans(start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans of each owner."""
    if len(start) == 0:
        return start, end, owner
    order = np.lexsort((start, owner))
    start, end, owner = start[order], end[order], owner[order]
    reach = end.copy()
    shift = owner.astype(np.int64) - owner.min()
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(reach + shift * wide) - shift * wide
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])
    stops = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return start[new], reach[stops], owner[new]


def _record_groups(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Records of (id, tie, text) rows, of about GROUP_BYTES of text at a
    time: id, tie, start in the text, windows after it, anchor, cover."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for b in batches:
        ids, ties = np.asarray(b.column(0)), np.asarray(b.column(1))
        for i, j, data, offsets in B.byte_slices(b.column(2), SLICE_BYTES):
            text, first, more, g, cover = records(data, offsets, length, gram)
            held.append((ids[i:j][text], ties[i:j][text], first - offsets[text], more, g, cover))
            size += len(data)
            B.release(len(data))
            if size >= GROUP_BYTES:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _earliest(key: tuple[np.ndarray, ...], ids: np.ndarray, ties: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are the earliest with their key, and rows that are not.  A
    row that repeats the earliest's id, tie and place is neither."""
    order = np.lexsort((place, ties, ids, *key[::-1]))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in key:
        same &= k[order][1:] == k[order][:-1]
    head = np.concatenate([[True], ~same])[: len(order)]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    again = (ids[order] == ids[order][lead]) & (ties[order] == ties[order][lead]) & (place[order] == place[order][lead])
    return order[head], order[~again]


def _place(start: np.ndarray, more: np.ndarray) -> np.ndarray:
    return (start << _START) | more


_ROW = "g long, salt int, ctx long, id long, tie long, pos long"


def _frame(g, salt, ctx, ids, ties, pos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (
        np.asarray(g).view(np.int64), np.asarray(salt, np.int32), np.asarray(ctx).view(np.int64), ids, ties, pos)],
        names=["g", "salt", "ctx", "id", "tie", "pos"])


def _span_frame(ids, ties, start, end) -> pa.RecordBatch:
    """Removed spans among the rows: salt -2, ctx holds the end."""
    spread = B.mix64((ids.astype(_U) << _U(20)) ^ ties.astype(_U) ^ start.astype(_U))
    return _frame(spread, np.full(len(ids), -2), end.astype(np.int64), ids, ties, _place(start, np.zeros(len(ids), np.int64)))


def _record_rows(heavy: np.ndarray, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ties, start, more, g, cover in _record_groups(batches, length, gram):
            place = _place(start, more)
            keep, repeat = _earliest((g, cover), ids, ties, place)
            salt = np.full(len(g), -1)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, g), len(heavy) - 1)
                salt = np.where(heavy[at] == g, (cover % _U(SALTS)).astype(np.int64), -1)
            yield _frame(g[keep], salt[keep], cover[keep], ids[keep], ties[keep], place[keep])
            if len(repeat):
                text = np.unique(np.stack([ids[repeat], ties[repeat]]), axis=1, return_inverse=True)
                s, e, owner = merge_spans(start[repeat], start[repeat] + more[repeat] + length, text[1].ravel())
                yield _span_frame(text[0][0][owner], text[0][1][owner], s, e)

    return run


def _local_counts(length: int, gram: int):
    """Anchors with several contexts in one group of texts, and how many; and
    the number of records (whole)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, _, g, cover in _record_groups(batches, length, gram):
            order = np.lexsort((cover, g))
            g, cover = g[order], cover[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (cover[1:] != cover[:-1])
            anchors, n = np.unique(g[new], return_counts=True)
            anchors, n = anchors[n > 1], n[n > 1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(anchors.view(np.int64), 0)), pa.array(np.append(n, len(g))),
                pa.array(np.append(np.zeros(len(n), bool), True))], names=["g", "n", "whole"])

    return run


# --- shards ------------------------------------------------------------------

def _phrase_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Phrase starts of concatenated records: each record's first byte, and
    places where the byte pair around them hashes to a boundary."""
    pair = data[:-1].astype(_U) * _U(256) + data[1:]
    cut = np.zeros(len(data), bool)
    cut[1:] = B.mix64(pair + _U(1)) % _U(PHRASE) == 0
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


def _ranks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rank of each phrase among the distinct phrases, in byte order, from 1."""
    raw = data.tobytes()
    phrases = [raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    place = {p: k for k, p in enumerate(sorted(set(phrases)), 1)}
    return np.array([place[p] for p in phrases], np.int64)


def _common(data: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Common prefix lengths of data[a:] and data[b:], at most ``room``."""
    out = np.zeros(len(a), np.int64)
    padded = np.append(data, np.zeros(length, np.uint8))
    view = np.lib.stride_tricks.sliding_window_view(padded, length)
    for k in range(0, len(a), 8192):
        x, y = view[a[k: k + 8192]], view[b[k: k + 8192]]
        differ = x != y
        d = differ.argmax(axis=1)
        out[k: k + 8192] = np.where(differ.any(axis=1), d, length)
    return np.minimum(out, room)


def shard_repeats(data: np.ndarray, offsets: np.ndarray, order_key: np.ndarray, length: int) -> np.ndarray:
    """Windows (byte places in ``data``, each inside one record) that equal a
    window with a smaller key.  ``order_key`` is each record's rank in corpus
    order; windows of one record rank by place."""
    record = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = _phrase_starts(data, offsets)
    owner = record[starts]
    ends = np.append(starts[1:], len(data))
    ranks = _ranks(data, starts, ends)
    # a separator (rank 0) after each record keeps suffixes inside it
    symbols = np.zeros(len(starts) + len(offsets) - 1, np.int64)
    symbols[np.arange(len(starts)) + owner] = ranks
    back = np.full(len(symbols), -1)
    back[np.arange(len(starts)) + owner] = np.arange(len(starts))
    sa = back[suffix_array(symbols)]
    sa = sa[sa >= 0]
    at = starts[sa]
    room = offsets[owner[sa] + 1] - at
    shared = np.zeros(len(sa), np.int64)
    shared[1:] = _common(data, at[1:], at[:-1], np.minimum(room[1:], room[:-1]), length)
    before = np.where((sa > 0) & (at > offsets[owner[sa]]), at - starts[np.maximum(sa - 1, 0)], 0)
    gone = []
    for a in range(1, min(length, int(before.max(initial=0)) + 1)):
        group = np.cumsum(shared < length - a)
        pick = np.flatnonzero((before >= a) & (room >= length - a))
        if len(pick) < 2:
            continue
        several = np.bincount(group[pick], minlength=1)
        pick = pick[several[group[pick]] > 1]
        if len(pick) < 2:
            continue
        window = at[pick] - a
        left = B.span_hashes(data, window, at[pick], _AS_IS)
        gone.append(window[_not_first((group[pick], left), order_key[record[window]], window)])
    # windows without a boundary inside: compared whole
    whole = np.arange(max(0, len(data) - length + 1))
    follow = np.append(starts, len(data) + length)[np.searchsorted(starts, whole, "right")]
    whole = whole[(follow >= whole + length) & (whole + length <= offsets[record[whole] + 1])] if len(whole) else whole
    if len(whole) > 1:
        h = B.span_hashes(data, whole, whole + length, _AS_IS), _second_hash(data, whole, whole + length)
        gone.append(whole[_not_first(h, order_key[record[whole]], whole)])
    return np.concatenate(gone) if gone else np.zeros(0, np.int64)


def live_pieces(data: np.ndarray, offsets: np.ndarray, more: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Parts of records that may hold repeated windows: record, first window
    and last window of each.  Windows of a record are taken in blocks of BLOCK
    by their distance from the anchor; if the bytes that all windows of a block
    share occur in no other record, none of its windows does."""
    g = _gram_hashes(*B.running_hash(data, _AS_IS), gram) & _HIGH
    g |= np.arange(len(g), dtype=_U)
    base = offsets[:-1]
    ends = np.stack([base + more, base + length - gram + 1], axis=1).ravel()  # the grams that all its windows hold
    anchor = (np.minimum.reduceat(np.append(g, _U(_LAST)), ends)[::2] & ~_HIGH).astype(np.int64) - base
    low, high = (anchor - more) // BLOCK, anchor // BLOCK  # blocks of the last and the first window
    n = high - low + 1
    record = np.repeat(np.arange(len(more)), n)
    block = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    core = base[record] + anchor[record] - block * BLOCK
    key = B.span_hashes(data, core, core + length - BLOCK + 1, _AS_IS) + block.astype(_U) * _U(0xA24BAED4963EE407)
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    live = count[which] > 1
    record, block = record[live], block[live]
    first = np.maximum(anchor[record] - block * BLOCK - BLOCK + 1, 0)
    last = np.minimum(anchor[record] - block * BLOCK, more[record])
    # blocks of a record come with falling windows; neighbours make one piece
    start, end, owner = merge_spans(first, last + 1, record)
    return owner, start, end - 1


def _not_first(key: tuple[np.ndarray, ...], order: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Indices of rows that are not the first of their key."""
    by = np.lexsort((place, order, *key[::-1]))
    same = np.ones(len(by) - 1, bool)
    for k in key:
        same &= k[by][1:] == k[by][:-1]
    return by[1:][same]


def _unpack(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pos >> _START, pos & ((1 << _START) - 1)


_SPANS = "id long, tie long, start long, end long"


def _spans(ids, ties, start, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x, np.int64)) for x in (ids, ties, start, end)], names=["id", "tie", "start", "end"])


def _shard_spans(rows: pa.Table, length: int, gram: int) -> pa.RecordBatch:
    """Removed spans of a shard's records (id, tie, pos, bytes)."""
    ids, ties, pos = rows["id"].to_numpy(), rows["tie"].to_numpy(), rows["pos"].to_numpy()
    order = np.lexsort((pos, ties, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (ties[order][1:] != ties[order][:-1]) | (pos[order][1:] != pos[order][:-1])
    order = order[new]  # rows that repeat an id and a text are one
    rows = rows.take(pa.array(order))
    ids, ties, (start, more) = ids[order], ties[order], _unpack(pos[order])
    column = rows["bytes"].combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    offsets = offsets - offsets[0]
    record, first, last = live_pieces(data, offsets, more, length, gram)
    size = last - first + length
    at = np.cumsum(size) - size
    piece = data[np.repeat(offsets[record] + first - at, size) + np.arange(size.sum())]
    gone = shard_repeats(piece, np.append(at, size.sum()), record, length) if len(record) else at
    which = np.searchsorted(at, gone, "right") - 1
    record = record[which]
    s = gone - at[which] + first[which] + start[record]
    s, e, record = merge_spans(s, s + length, record)
    return _spans(ids[record], ties[record], s, e)


def _by_anchor(table: pa.Table, stop: int) -> Iterator[pa.Table]:
    """The first ``stop`` rows in pieces of about SHARD_BYTES, each ending
    with its last anchor's rows."""
    g, ends = table["g"].to_numpy(), np.cumsum(_lengths(table["bytes"]))
    done = 0
    while done < stop:
        k = int(np.searchsorted(ends, (ends[done - 1] if done else 0) + SHARD_BYTES, "left"))
        k = int(np.searchsorted(g, g[min(k, stop - 1)], "right"))
        yield table.slice(done, k - done)
        done = k


def _shards(length: int, gram: int):
    """Rows sorted by anchor, cut into shards between anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            size += b.column(4).nbytes
            if size >= SHARD_BYTES:
                table = pa.concat_tables(held).combine_chunks()
                g = table["g"].to_numpy()
                whole = int(np.searchsorted(g, g[-1], "left"))  # the last anchor may go on
                for piece in _by_anchor(table, whole):
                    yield _shard_spans(piece, length, gram)
                held = [table.slice(whole)]
                size = int(_lengths(held[0]["bytes"]).sum())
        if held:
            table = pa.concat_tables(held).combine_chunks()
            for piece in _by_anchor(table, table.num_rows):
                yield _shard_spans(piece, length, gram)

    return run


def _lengths(column) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.binary_length(column), np.int64)


def _cut_regions(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted records of each text (id, tie, text, wanted)."""
    for b in batches:
        ids, ties = b.column(0).to_pylist(), b.column(1).to_pylist()
        g, salt, out_id, out_tie, out_pos, raw = [], [], [], [], [], []
        for k, i in enumerate(ids):
            text = b.column(2)[k].as_py().encode("utf-8")
            for w in b.column(3)[k].as_py():
                start = w["pos"] >> _START
                g.append(w["g"])
                salt.append(w["salt"])
                out_id.append(i)
                out_tie.append(ties[k])
                out_pos.append(w["pos"])
                raw.append(text[start: start + (w["pos"] & 127) + length])
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(out_id, pa.int64()), pa.array(out_tie, pa.int64()), pa.array(out_pos, pa.int64()),
                                          pa.array(raw, pa.binary()), pa.array(salt, pa.int32())], names=["g", "id", "tie", "pos", "bytes", "salt"])


def _window_rows(length: int):
    """Every window of the records of frequent anchors, keyed by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 16_384):
                some = pa.Table.from_batches([b.slice(k, 16_384)]).combine_chunks()
                ids, ties, (start, more) = some["id"].to_numpy(), some["tie"].to_numpy(), _unpack(some["pos"].to_numpy())
                size = _lengths(some["bytes"])
                offsets = np.cumsum(size) - size
                data = np.frombuffer(b"".join(some["bytes"].to_pylist()), np.uint8)
                record = np.repeat(np.arange(len(ids)), more + 1)
                step = np.arange(len(record)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                at = offsets[record] + step
                one, two = B.span_hashes(data, at, at + length, _AS_IS), _second_hash(data, at, at + length)
                s = start[record] + step
                place = _place(s, np.zeros(len(s), np.int64))
                keep, repeat = _earliest((one, two), ids[record], ties[record], place)
                yield _frame(one[keep], np.full(len(keep), -1), two[keep], ids[record][keep], ties[record][keep], place[keep])
                if len(repeat):
                    rs, re, owner = merge_spans(s[repeat], s[repeat] + length, record[repeat])
                    yield _span_frame(ids[owner], ties[owner], rs, re)

    return run


def _removed(df: DataFrame, length: int) -> DataFrame:
    """Spans of rows marked as repeats (pos, or ctx as the end for spans)."""
    start = F.shiftright("pos", _START)
    end = F.when(F.col("salt") == -2, F.col("ctx")).otherwise(start + F.col("pos").bitwiseAND(F.lit(127)) + length)
    return df.select("id", "tie", start.alias("start"), end.alias("end"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``texts`` has id, tie, text.  Returns removed spans: id, tie, start,
    end (bytes), overlapping ones not yet merged."""
    spark = texts.sparkSession
    some = texts.where(F.octet_length("text") >= length)
    counts = written(some.mapInArrow(_local_counts(length, gram), "g long, n long, whole boolean")
                     .groupBy("g", "whole").agg(F.sum("n").alias("n")), "repeat-anchors")
    least = max(2.0, ((counts.where("whole").agg(F.sum("n")).first()[0] or 0) ** 0.5) / ROOT_PART)
    top = counts.where(~F.col("whole") & (F.col("n") >= least)).orderBy(F.desc("n"), "g").limit(HEAVY).toPandas()
    heavy = np.sort(top["g"].to_numpy(np.int64).view(_U))
    rows = some.mapInArrow(_record_rows(heavy, length, gram), _ROW)

    same = Window.partitionBy("g", "salt", "ctx").orderBy("id", "tie", "pos")
    anchor = Window.partitionBy("g", "salt")
    judged = rows.withColumns({
        "again": (F.col("salt") != -2) & (F.rank().over(same) > 1),
        "several": (F.min("ctx").over(anchor) != F.max("ctx").over(anchor)) | (F.col("salt") >= 0)})
    judged = written(judged.where("again or several or salt = -2").select("g", "salt", "ctx", "id", "tie", "pos", "again"), "repeat-records")
    spans = _removed(judged.where("again or salt = -2"), length)

    wanted = (judged.where("not again and salt > -2").groupBy("id", "tie")
              .agg(F.collect_list(F.struct("g", "salt", "pos")).alias("wanted")))
    regions = written(some.join(wanted, ["id", "tie"]).select("id", "tie", "text", "wanted").mapInArrow(
        lambda batches: _cut_regions(batches, length), "g long, id long, tie long, pos long, bytes binary, salt int"), "repeat-regions")
    by_suffix = (regions.where("salt < 0").select("g", "id", "tie", "pos", "bytes").repartition("g").sortWithinPartitions("g")
                 .mapInArrow(_shards(length, gram), _SPANS))
    windows = regions.where("salt >= 0").mapInArrow(_window_rows(length), _ROW)
    windows = windows.withColumn("again", F.rank().over(same) > 1).where("again or salt = -2")
    return spans.unionByName(by_suffix).unionByName(_removed(windows, length))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their removed spans (id, text, spans)."""
    schema = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            some = b.slice(at, 1024)
            sizes, merged, kept = [], [], []
            for text, spans in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8")
                runs: list[list[int]] = []
                for s in sorted((x["start"], x["end"]) for x in spans or []):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append([*s])
                cuts = [0, *[x for r in runs for x in r], len(raw)]
                kept.append(b"".join(raw[cuts[k]: cuts[k + 1]] for k in range(0, len(cuts), 2)))
                sizes.append(len(raw))
                merged.append([{"start": s, "end": e} for s, e in runs])
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sizes, pa.int64()), pa.array(merged, schema), pa.array(kept, pa.binary())],
                                             names=["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per input row: the id, n_bytes, spans (maximal removed runs, in
    bytes, end exclusive) and kept (the remaining bytes)."""
    ship_package(docs.sparkSession)
    if not 8 <= gram <= length < 128:
        raise ValueError("needs 8 <= gram <= length < 128")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"),
                       F.xxhash64(text).alias("tie"), text.alias("text"))
    spans = repeated_spans(rows.select("id", "tie", "text"), length, gram)
    per_text = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    kind = rows.schema["own"].dataType.simpleString()
    out = rows.join(per_text, ["id", "tie"], "left").select("own", "text", "spans").mapInArrow(
        _cut, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    return found.select(
        id_col, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
