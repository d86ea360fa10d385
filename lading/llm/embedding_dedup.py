"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are scaled to length 1, so cosine and distance order pairs alike.  A
table hashes a vector by ``projections`` random Gaussian directions, each
projection quantised in steps of ``WIDTH`` from a random offset; vectors that
agree on all of them share the table's bucket.  Vectors in a bucket are
compared exactly (double precision).

The number of projections follows the number of vectors (so that a bucket
holds about ``LOAD`` unrelated vectors at any size), and the number of tables
follows from it so that a pair right at the threshold meets in some table with
probability ``1 - MISS`` (closer pairs: more).

Equal vectors are one class before hashing.  A large bucket is split into
tiles, every pair of tiles being a task group of its own.  A pair counts in
the first table in which it meets, so each link is counted once; a group
returns link counts and a spanning forest of its links, never pairs.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing, nor do vectors of different lengths; rows with a null id link
with nothing, have a null component and are kept.  Rows that repeat an id are
one node.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.bytetext import mix64
from lading.llm.graph import components, written
from lading.session import ship_package

THRESHOLD = 0.95
#: Quantisation step, in units of the (unit) vector length.
WIDTH = 2.0
LOAD = 0.2
MISS = 1e-3
TILE = 128

_U = np.uint64


def share_chance(distance: float, width: float) -> float:
    """Chance that two points at a distance fall into one step of a Gaussian
    projection (Datar, Immorlica, Indyk, Mirrokni 2004)."""
    r = width / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, threshold: float, width: float, load: float, miss: float) -> tuple[int, int]:
    """Projections a table and tables, for a number of vectors."""
    far, near = share_chance(math.sqrt(2), width), share_chance(math.sqrt(2 - 2 * threshold), width)
    projections = max(1, math.ceil(math.log(max(2.0, rows / load)) / -math.log(far)))
    return projections, math.ceil(math.log(miss) / math.log1p(-near ** projections))


class Hasher:
    """Bucket keys of unit vectors.  Vectors and directions are rounded to
    integers that double precision adds exactly, so a key does not depend on
    the batch a vector is hashed in."""

    def __init__(self, projections: int, tables: int, width: float):
        self.projections, self.tables, self.width = projections, tables, width
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def keys(self, unit: np.ndarray, tables: int | None = None) -> np.ndarray:
        """One 64-bit key per vector and table (the first ``tables``)."""
        tables = self.tables if tables is None else tables
        dim, n = unit.shape[1], self.projections * self.tables
        if dim not in self.known:
            rng = np.random.default_rng([95, dim])
            self.known[dim] = np.rint(rng.standard_normal((dim, n)) * 2.0**16), np.floor(rng.random(n) * self.width * 2.0**36)
        directions, offset = (x[..., : tables * self.projections] for x in self.known[dim])
        step = np.floor((np.rint(unit * 2.0**20) @ directions + offset) / (self.width * 2.0**36)).astype(np.int64).view(_U)
        step = step.reshape(len(unit), tables, self.projections)
        key = np.broadcast_to((np.arange(tables).astype(_U) * _U(0xA24BAED4963EE407) + _U(dim)), step.shape[:2])
        for k in range(self.projections):
            key = mix64(key + step[:, :, k])
        return key


def _units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by vector length: row numbers and unit vectors."""
    offsets = np.asarray(column.offsets, np.int64)
    values = np.asarray(column.values, np.float64)
    size = np.diff(offsets)
    out = []
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        x = values[offsets[rows][:, None] + np.arange(dim)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
        out.append((rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _link_tiles(group: pa.Table, hasher: Hasher, threshold: float) -> pa.Table:
    rep, weight = group["rep"].to_numpy(), group["weight"].to_numpy()
    side, table = group["side"].to_numpy(), group["t"][0].as_py()
    one = group["lt"][0].as_py() == group["rt"][0].as_py()
    (_, unit), = _units(group["vector"].combine_chunks())
    left = np.arange(len(rep)) if one else np.flatnonzero(side == 0)
    right = left if one else np.flatnonzero(side == 1)
    i, j = np.nonzero(unit[left] @ unit[right].T >= threshold)
    i, j = left[i], right[j]
    if one:
        i, j = i[i < j], j[i < j]
    if len(i) and table:  # met in an earlier table: counted there
        used = np.unique(np.concatenate([i, j]))
        keys = hasher.keys(unit[used], table)
        a, b = keys[np.searchsorted(used, i)], keys[np.searchsorted(used, j)]
        first = ~(a == b).any(axis=1)
        i, j = i[first], j[first]
    links, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    cuts = np.flatnonzero(np.diff(i)) + 1
    for some, k in zip(np.split(j, cuts), i[np.concatenate([[0], cuts])].tolist() if len(i) else [], strict=False):
        merge = np.unique(np.append(label[some], label[k]))
        if len(merge) > 1:
            label[np.isin(label, merge)] = merge[0]
    out = np.flatnonzero(links)
    return pa.table({"a": rep[out], "b": rep[label[out]], "links": links[out]})


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 width: float = WIDTH, load: float = LOAD, miss: float = MISS, tile: int = TILE) -> DataFrame:
    """One row per input row: the id, n_links (other rows linked directly),
    component_id (smallest id reachable by links, itself included) and kept
    (the id is its component's)."""
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("good", F.coalesce(finite & F.col("id").isNotNull(), F.lit(False)))
    rows = rows.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(95), "vector")})
    good = rows.where("good")
    classes = written(good.groupBy("k1", "k2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector")), "vector-classes")

    hasher = Hasher(*plan(classes.count(), threshold, width, load, miss), width)

    def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                column = b.column(1)
                column = pa.ListArray.from_arrays(pa.array(np.asarray(column.offsets) - column.offsets[0].as_py(), pa.int32()), column.flatten())
                keys = np.zeros((b.num_rows, hasher.tables), _U)
                for where, unit in _units(column):
                    keys[where] = hasher.keys(unit)
                ends = pa.array(np.arange(0, keys.size + 1, hasher.tables), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64).ravel()))], names=["rep", "keys"])

    keys = (classes.select("rep", "vector").mapInArrow(hash_batches, "rep long, keys array<long>")
            .select("rep", F.posexplode("keys").alias("t", "bucket")))
    keys = written(keys, "vector-buckets")
    # A bucket with the members of one in an earlier table adds nothing.
    members = [F.bit_xor(F.xxhash64(F.lit(k), "rep")).alias(f"s{k}") for k in (1, 2)]
    sizes = keys.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("m"), *members).where("m > 1")
    sizes = sizes.groupBy("m", "s1", "s2").agg(F.min(F.struct("t", "bucket")).alias("at")).select("at.*", "m")
    shared = keys.join(sizes.select("t", "bucket", F.ceil(F.col("m") / tile).cast("long").alias("tiles")), ["t", "bucket"])
    own = F.pmod(F.xxhash64("rep"), F.col("tiles"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda s: F.struct(
        F.least(own, s).alias("lt"), F.greatest(own, s).alias("rt"), (own > s).cast("int").alias("side")))
    placed = (shared.select("rep", F.struct("t", "bucket").alias("place"), F.explode(pairs).alias("pair"))
              .join(classes.select("rep", "weight", "vector"), "rep")
              .select("rep", "weight", "vector", "place.t", "place.bucket", "pair.*"))
    found = written(placed.groupBy("t", "bucket", "lt", "rt").applyInArrow(
        lambda g: _link_tiles(g, hasher, threshold), "a long, b long, links long"), "vector-links")

    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b").distinct())
    per_class = (classes.select("k1", "k2", "rep", "weight").join(links, "rep", "left")
                 .join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
                 .select("k1", "k2", F.coalesce("component", "rep").alias("component"),
                         (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")))
    linked = good.select("id", "k1", "k2").join(per_class, ["k1", "k2"]).select("id", "links", "component")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
