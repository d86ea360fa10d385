"""Exact Jaccard join of documents on sets of word n-grams.

1. Every text becomes the sorted array of its distinct n-gram hashes (64 bit).
   Documents with equal sets are one class from here on.
2. Classes that share a MinHash band meet in its bucket.  With ``ROWS`` rows a
   band there are as many bands as a pair at the threshold needs to share one
   but for a chance of ``MISS`` (less above it).  There they compare bitmap
   signatures, one bit of each minimum: bits agree with chance (1 + J) / 2, and a
   pair whose agreeing bits a linked pair would fall short of with a chance of
   ``MISS`` at most (Chernoff's bound) is let go.  So pages of one template, which
   share bands by chance, are not chained to each other.  Pairs that remain
   connect clusters; clusters only say where to compare.  Buckets of more than
   ``BUCKET_TILE`` classes are dealt to pairs of tiles.
3. A cluster is cut into tiles by set size: two sets can only link if the
   smaller has the threshold's share of the larger's elements, so a tile meets tiles of
   its own and of the next size band.  A size band is split into tiles of at most
   ``TILE`` classes and about ``TILE_BYTES`` of sets; every pair of tiles is a task
   group of its own.
4. In a pair of tiles, hashed parity bitmaps are compared first: elements in
   one set only flip bits, so the Hamming distance is at most the symmetric
   difference and bounds the overlap from above.  Pairs that pass are
   intersected exactly on the sorted arrays.
5. A pair of tiles returns link counts and a spanning forest of its links;
   pairs are never emitted.  The forests' components are the result.

Words are runs of bytes other than space and \\x09-\\x0D after lower-casing
A-Z.  A text with fewer than n words has its whole word sequence as the only
n-gram; without words (null and empty texts too) the set is empty and links
with nothing.  Rows with a null id link with nothing and have a null
component.  Rows that repeat an id are one node.  Extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm import bytetext as B
from lading.llm.graph import components, written
from lading.llm.narrow import may_match
from lading.session import ship_package

N = 5
PERCENT = 80
#: MinHash rows a band, and the chance that a pair at the threshold shares no band.
ROWS, MISS = 6, 1e-9
TILE = 512
TILE_BYTES = 16 << 20
BUCKET_TILE = 4096
#: Parity bitmaps have as many bits as the largest set of a tile pair, within these.
BITS = (256, 1 << 16)

_U = np.uint64


def _is_word() -> np.ndarray:
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    starts, ends, first = B.word_bounds(data, offsets, _is_word())
    words = B.span_hashes(data, starts, ends, B.lower_ascii())
    keys = [B.mix64(np.array([0x51ED270B * (k + 1)], _U))[0] | _U(1) for k in range(n)]
    grams = np.zeros(max(0, len(words) - n + 1), _U)
    for k in range(n):
        grams += words[k: len(words) - n + 1 + k] * keys[k]
    grams = B.mix64(grams)
    for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if e - s >= n:
            yield np.unique(grams[s: e - n + 1])
        elif e > s:
            whole = B.mix64(np.array([e - s], _U))
            for k in range(e - s):
                whole = whole + words[s + k: s + k + 1] * keys[k]
            yield B.mix64(whole)
        else:
            yield np.zeros(0, _U)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(8_500_044)
    return rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, count, dtype=np.uint32)


def band_keys(values: np.ndarray, rows: int, bands: int, functions: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, bytes]:
    """MinHash band keys of a set (one 64-bit key a band) and its signature (one
    bit a minimum, in whole 64-bit words)."""
    mult, add = functions
    low = np.full(len(mult), 0xFFFFFFFF, np.uint32)
    short = (values >> _U(32)).astype(np.uint32)
    for k in range(0, len(short), 4096):
        np.minimum(low, (short[k: k + 4096, None] * mult + add).min(axis=0), out=low)
    key = np.arange(bands).astype(_U) * _U(0xA24BAED4963EE407)
    for k in range(rows):
        key = B.mix64(key + low.reshape(bands, rows)[:, k].astype(_U))
    bits = np.zeros(-(-len(low) // 64) * 64, bool)
    bits[: len(low)] = low * np.uint32(0x9E3779B1) >> np.uint32(31)
    return key, np.packbits(bits).tobytes()


def most_apart(count: int, percent: int, miss: float) -> int:
    """Signature bits out of ``count`` that may differ in a pair at the
    threshold, but for a chance of at most ``miss``."""
    p = (1 + percent / 100) / 2

    def bound(agree: int) -> float:  # chance that no more bits than these agree
        q = agree / count
        return math.exp(-count * ((q * math.log(q / p) if q else 0.0) + (1 - q) * math.log((1 - q) / (1 - p))))

    least = 0
    while least + 1 < p * count and bound(least) <= miss:
        least += 1
    return count - least


def set_tables(docs: DataFrame, id_col: str, text_col: str, n: int, rows: int, bands: int) -> DataFrame:
    """Per row: id, n_shingles, a 128-bit key of the set, band keys, signature."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions(rows * bands)
        for b in batches:
            for i, j, data, offsets in B.byte_slices(b.column(1)):
                size, one, two, keys, signs = [], [], [], [], []
                for v in ngram_sets(data, offsets, n):
                    size.append(len(v))
                    one.append(int(B.mix64(v).sum(dtype=_U)))
                    two.append(int(B.mix64(v ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)))
                    key, sign = band_keys(v, rows, bands, functions) if len(v) else (np.zeros(0, _U), b"")
                    keys.append(key.view(np.int64))
                    signs.append(sign)
                B.release(len(data))
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i), pa.array(size, pa.int64()),
                    pa.array(np.array(one, _U).view(np.int64)), pa.array(np.array(two, _U).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys))),
                    pa.array(signs, pa.binary())],
                    names=["id", "n", "k1", "k2", "bands", "sign"])

    return source.mapInArrow(describe, "id long, n long, k1 long, k2 long, bands array<long>, sign binary")


# --- buckets -----------------------------------------------------------------

def bucket_links(ends: np.ndarray, side: np.ndarray, size: np.ndarray, signs: np.ndarray, percent: int, apart: int) -> np.ndarray:
    """Rows lie bucket by bucket; ``ends`` is the end of each row's bucket,
    ``side`` -1 in a bucket that is one tile.  Joins rows whose signatures are
    near; pairs already joined are not compared.  Returns a label per row: the
    first row it is joined with."""
    label = np.arange(len(ends))
    rows, step = label.copy(), 0
    while True:
        step += 1
        rows = rows[rows + step < ends[rows]]
        if len(rows) == 0:
            return label
        i = rows[(label[rows] != label[rows + step]) & ((side[rows] < 0) | (side[rows] != side[rows + step]))]
        j = i + step
        less, more = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
        fits = 100 * less >= percent * more
        i, j = i[fits], j[fits]
        near = np.bitwise_count(signs[i] ^ signs[j]).sum(axis=1, dtype=np.int64) <= apart
        if near.any():
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while x in root:
                    x = root[x]
                return x

            for a, b in zip(label[i[near]].tolist(), label[j[near]].tolist(), strict=True):
                a, b = top(a), top(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            to = np.arange(len(label))
            for x in root:
                to[x] = top(x)
            label = to[label]


def _walk_buckets(batches: Iterator[pa.RecordBatch], percent: int, apart: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (key, lt, rt).  The last bucket of a batch waits for the
    next one; a bucket has at most two tiles of rows."""
    carry: pa.Table | None = None

    def joined(t: pa.Table) -> pa.RecordBatch:
        rep, size, signs = t["rep"].to_numpy(), t["n"].to_numpy(), np.frombuffer(b"".join(t["sign"].to_pylist()), _U).reshape(len(t), -1)
        place = np.stack([t[c].to_numpy() for c in ("key", "lt", "rt")])
        cuts = np.flatnonzero(np.append((place[:, 1:] != place[:, :-1]).any(axis=0), True)) + 1
        ends = np.repeat(cuts, np.diff(cuts, prepend=0))
        label = bucket_links(ends, t["side"].to_numpy(), size, signs, percent, apart)
        least = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(least, label, rep)
        a, b = rep, least[label]
        pairs = np.unique(np.stack([a, b])[:, a != b], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    for batch in batches:
        t = pa.Table.from_batches([batch])
        if carry is not None:
            t = pa.concat_tables([carry, t])
        if len(t) == 0:
            continue
        last = len(t) - 1
        whole = np.ones(len(t), bool)
        for c in ("key", "lt", "rt"):
            v = t[c].to_numpy()
            whole &= v == v[last]
        start = last + 1 - int(np.argmin(whole[::-1])) if not whole.all() else 0
        carry = t.slice(start).combine_chunks()
        if start:
            yield joined(t.slice(0, start))
    if carry is not None and len(carry):
        yield joined(carry)


def _near_in_buckets(classes: DataFrame, percent: int, apart: int, tile: int) -> DataFrame:
    """Pairs (a, b) that connect classes near by signature within a bucket."""
    rows = classes.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    mine = rows.join(shared, "key").select("rep", "key", F.ceil(F.col("m") / tile).cast("long").alias("tiles"))
    own = F.pmod(F.xxhash64("rep"), F.col("tiles"))
    meets = F.when(F.col("tiles") == 1, F.array(F.struct(own.alias("lt"), own.alias("rt"), F.lit(-1).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: F.struct(
            F.least(own, t).alias("lt"), F.greatest(own, t).alias("rt"),
            F.when(own == t, -1).otherwise((own > t).cast("int")).alias("side"))))
    dealt = (mine.join(classes.select("rep", "n", "sign"), "rep")
             .select("rep", "key", "n", "sign", F.explode(meets).alias("meet")).select("rep", "key", "n", "sign", "meet.*"))
    # Rows of a tile that meets itself say -1; of two tiles, 0 and 1.
    return (dealt.repartition("key", "lt", "rt").sortWithinPartitions("key", "lt", "rt")
            .mapInArrow(lambda batches: _walk_buckets(batches, percent, apart), "a long, b long").distinct())


# --- tiles -------------------------------------------------------------------

def _tile_keys(members: DataFrame, percent: int, tile: int) -> DataFrame:
    """Which tile pairs a class takes part in.  ``members``: rep, cluster, n.
    Adds keys: array of (cluster, left band, left tile, right band, right
    tile, side)."""
    width = math.log(1 / (percent / 100 - 0.001))  # a little wide: rounding never parts a pair
    rows = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / width))
    sizes = rows.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("m"), (F.sum("n") * 8).alias("bytes"))
    need = F.ceil(F.greatest(F.col("m") / tile, F.col("bytes") / TILE_BYTES)).cast("long")
    whole = sizes.groupBy("cluster").agg(F.sum("m").alias("all"), F.sum("bytes").alias("bytes"), F.map_from_entries(F.collect_list(F.struct(
        "band", need.alias("tiles")))).alias("tiles"))
    rows = rows.join(whole, "cluster")

    def tiles(band: Column) -> Column:
        return F.coalesce(F.element_at("tiles", band), F.lit(0))

    band = F.col("band")
    own = F.pmod(F.xxhash64("rep"), tiles(band))

    def pairs(left: Column, lt: Column, right: Column, rt: Column, side: Column) -> Column:
        return F.struct(F.col("cluster"), left.alias("lb"), lt.alias("lt"), right.alias("rb"), rt.alias("rt"), side.alias("side"))

    def upto(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))

    zero = F.lit(0).cast("long")
    keys = F.when((F.col("all") <= tile) & (F.col("bytes") <= TILE_BYTES), F.array(pairs(zero, zero, zero, zero, F.lit(0)))).otherwise(F.concat(
        F.transform(upto(tiles(band)), lambda t: pairs(band, F.least(own, t), band, F.greatest(own, t), (own > t).cast("int"))),
        F.transform(upto(tiles(band + 1)), lambda t: pairs(band, own, band + 1, t, F.lit(0))),
        F.transform(upto(tiles(band - 1)), lambda t: pairs(band - 1, t, band, own, F.lit(1)))))
    return rows.select("rep", "weight", keys.alias("keys"))


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bitmap of each set: bit k is the parity of the elements that
    hash to it."""
    top = max(len(v) for v in sets)
    bits = min(max(BITS[0], 1 << (top - 1).bit_length()), BITS[1])
    maps = np.zeros((len(sets), bits // 64), _U)
    for row, v in zip(maps, sets, strict=True):
        odd = np.flatnonzero(np.bincount((v & _U(bits - 1)).astype(np.int64), minlength=bits) & 1)
        np.bitwise_or.at(row, odd >> 6, _U(1) << (odd & 63).astype(_U))
    return maps


def tile_links(sets: list[np.ndarray], side: np.ndarray, percent: int, one_tile: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each row, the later rows that link with it (rows of the other side
    only unless ``one_tile``)."""
    size = np.array([len(v) for v in sets], np.int64)
    maps = _bitmaps(sets)
    order = np.argsort(size, kind="stable")
    size, side, maps = size[order], side[order], maps[order]
    sets = [sets[k] for k in order]
    for i in range(len(sets) - 1):
        # sizes rise: those whose share of elements this set still reaches
        end = int(np.searchsorted(size, size[i] * 100 // percent, "right"))
        js = np.arange(i + 1, end)
        if not one_tile:
            js = js[side[js] != side[i]]
        if len(js) == 0:
            continue
        apart = np.bitwise_count(maps[js] ^ maps[i]).sum(axis=1, dtype=np.int64)
        both = size[js] + size[i]
        most = (both - apart) // 2
        js = js[100 * most >= percent * (both - most)]
        if len(js) == 0:
            continue
        flat = np.concatenate([sets[j] for j in js])
        at = np.searchsorted(sets[i], flat)
        at[at == size[i]] = 0
        cuts = np.concatenate([[0], np.cumsum(size[js])[:-1]])
        shared = np.add.reduceat((sets[i][at] == flat).astype(np.int64), cuts)
        js = js[100 * shared >= percent * (size[js] + size[i] - shared)]
        if len(js):
            yield int(order[i]), order[js]


def _link_tiles(table: pa.Table, percent: int) -> pa.Table:
    sets = [np.frombuffer(v, _U) for v in table["set"].to_pylist()]
    rep, weight = table["rep"].to_numpy(), table["weight"].to_numpy()
    one = table["lb"][0].as_py() == table["rb"][0].as_py() and table["lt"][0].as_py() == table["rt"][0].as_py()
    label = np.arange(len(rep))
    links = np.zeros(len(rep), np.int64)
    for i, js in tile_links(sets, table["side"].to_numpy(), percent, one):
        links[i] += weight[js].sum()
        links[js] += weight[i]
        merge = np.unique(np.append(label[js], label[i]))
        if len(merge) > 1:
            label[np.isin(label, merge)] = merge[0]
    out = np.flatnonzero(links)
    return pa.table({"a": rep[out], "b": rep[label[out]], "links": links[out]})


# --- the join ----------------------------------------------------------------

def _texts_near(docs: DataFrame, id_col: str, text_col: str, members: DataFrame) -> DataFrame:
    """Texts (rep, text) of all ``members`` and few others: what has no near
    text does not go through the shuffle."""
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text")).where("rep is not null")
    return may_match(texts, "rep", members, "may").where("may").drop("may")


def ngram_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT,
               rows: int = ROWS, miss: float = MISS, tile: int = TILE, bucket_tile: int = BUCKET_TILE) -> DataFrame:
    """One row per input row: the id, n_shingles, n_links (other rows linked
    directly), component_id (smallest id reachable by links, itself
    included)."""
    spark = docs.sparkSession
    ship_package(spark)
    bands = math.ceil(math.log(miss) / math.log1p(-(percent / 100) ** rows))
    sets = written(set_tables(docs, id_col, text_col, n, rows, bands), "ngram-sets")
    linked = sets.where("id is not null and n > 0")
    classes = written(linked.groupBy("k1", "k2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sign").alias("sign")), "ngram-classes")
    apart = most_apart(rows * bands, percent, miss)
    clusters = written(components(_near_in_buckets(classes, percent, apart, bucket_tile)), "ngram-clusters")
    members = clusters.join(classes.select("rep", "weight", "n"), clusters["node"] == classes["rep"]).select("rep", F.col("component").alias("cluster"), "weight", "n")
    keyed = written(_tile_keys(members, percent, tile), "ngram-tiles")

    # the sets of those classes again, from their texts
    tiled = keyed.join(_texts_near(docs, id_col, text_col, keyed), "rep").select("rep", "weight", "keys", "text")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in B.byte_slices(b.column(3)):
                yield pa.RecordBatch.from_arrays([
                    *[b.column(k).slice(i, j - i) for k in range(3)],
                    pa.array([v.tobytes() for v in ngram_sets(data, offsets, n)], pa.binary())],
                    names=["rep", "weight", "keys", "set"])

    key_type = "struct<cluster:long,lb:long,lt:long,rb:long,rt:long,side:int>"
    placed = (tiled.mapInArrow(again, f"rep long, weight long, keys array<{key_type}>, set binary")
              .where(F.length("set") > 0)
              .select("rep", "weight", "set", F.explode("keys").alias("key")).select("rep", "weight", "set", "key.*"))
    found = written(placed.groupBy("cluster", "lb", "lt", "rb", "rt").applyInArrow(
        lambda t: _link_tiles(t, percent), "a long, b long, links long"), "ngram-links")

    joined = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    per_class = (classes.select("k1", "k2", "rep", "weight")
                 .join(links, "rep", "left")
                 .join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
                 .select("k1", "k2", F.coalesce("component", "rep").alias("component"),
                         (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    alone = sets.where("id is null or n = 0").select("id", "n", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    out = linked.select("id", "n", "k1", "k2").join(per_class, ["k1", "k2"]).select("id", "n", "links", "component").unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("links").alias("n_links"), F.col("component").alias("component_id"))
