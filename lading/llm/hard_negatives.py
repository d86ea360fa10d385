"""Hard-negative mining with a multiway hyperplane tree (GNAT: Brin 1995).

Vectors are scaled to integers and scored by exact inner products.  An extra
coordinate ``sqrt(M - |x|^2)`` (M: the largest squared length; 0 for anchors)
turns a score into a Euclidean distance: d^2 = |a|^2 + M - 2 * score.  A window
of scores thus is an annulus around the anchor.

The tree's split points are chosen farthest-first from a bounded sample of
``SAMPLE`` rows (one tree per vector length); every row then goes to its
nearest split point, level by level, and each split point stores the least and
the greatest distance to the rows of each sibling subtree, over all rows.  An
anchor drops a sibling where the triangle inequality shows that the stored
range and all its annuli cannot meet.  The leaves left are searched exactly, so
recall is 1.  A large leaf is cut into chunks of ``TILE_ROWS`` rows and the
anchors of a leaf into blocks; a task group is one chunk and one block and
returns a few rows per anchor, never its pairs.

Two searches run: the anchors' nearest rows of their own label (positives),
and per positive the highest rows of other labels within the window.  The
sample also gives first bounds: an anchor needs nothing below its k-th best
sample row.

Rows with a null id, label or vector, or with a null or non-finite component,
take no part, nor do those with a scaled component above 2**27 / sqrt(length),
whose scores would not fit a long.  Only vectors of equal length are compared;
empty vectors score 0 with each other.  Higher scores come first, equal ones by
the smaller id, then by the label.  Rows that repeat id, label and vector count
once; a row is never paired with one of its own id.  Extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lading.llm.graph import written
from lading.session import ship_package

SCALE = 256
#: Rows the split points are chosen from, per vector length (documented bound).
SAMPLE = 4096
#: Rows a leaf should hold, and split points of a node at most.
LEAF_ROWS = 1024
FAN = 16
TILE_ROWS = 4096
TILE_ANCHORS = 1024
#: Anchors worked on at once within a task.
ANCHORS_AT_ONCE = 256

_LOW, _HIGH = -(1 << 62), 1 << 62
_ROWS = "key long, id long, label long, dim int, q array<long>"


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def _lengths(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.float64)
    return (y * y).sum(axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through doubles where they hold them."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Node:
    """Split points (with their extra coordinate) and, per split point i and
    subtree j, the least and greatest distance from i to the rows below j."""

    def __init__(self, points: np.ndarray, extra: np.ndarray):
        self.points, self.extra = points.astype(np.float64), extra
        self.square = (self.points**2).sum(axis=1) + extra**2
        self.below: list[int] = []  # node number, or ~leaf
        self.lo = np.full((len(points), len(points)), np.inf)
        self.hi = np.full((len(points), len(points)), -np.inf)

    def distances(self, x: np.ndarray, square: np.ndarray, extra: np.ndarray) -> np.ndarray:
        d2 = (square + extra**2)[:, None] + self.square - 2 * (x @ self.points.T + extra[:, None] * self.extra)
        return np.sqrt(np.maximum(d2, 0))


class Tree:
    """The split points of one vector length and the sample they come from."""

    def __init__(self, most: float, rows: int, sample: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf_rows: int, fan: int):
        self.most, self.sample, self.ids, self.labels = most, sample, ids, labels
        self.nodes: list[Node] = []
        self.leaves = 0
        self.square = _lengths(sample)
        self.extra = np.sqrt(np.maximum(most - self.square, 0))
        self.root = self._grow(np.arange(len(sample)), rows, leaf_rows, fan)

    def _grow(self, some: np.ndarray, rows: float, leaf_rows: int, fan: int) -> int:
        wanted = min(fan, math.ceil(rows / leaf_rows))
        points = self._spread(some[: 3 * fan], wanted) if wanted > 1 and len(some) >= 2 * wanted else []
        if len(points) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        node = Node(self.sample[points], self.extra[points])
        self.nodes.append(node)
        at = len(self.nodes) - 1
        near = node.distances(self.sample[some].astype(np.float64), self.square[some], self.extra[some]).argmin(axis=1)
        for j in range(len(points)):
            mine = some[near == j]
            node.below.append(self._grow(mine, rows * len(mine) / len(some), leaf_rows, fan))
        return at

    def _spread(self, some: np.ndarray, wanted: int) -> list[int]:
        """Farthest-first choice; fewer where the candidates coincide."""
        x, chosen = self.sample[some].astype(np.float64), [0]
        apart = np.full(len(some), np.inf)
        while len(chosen) < wanted:
            k = chosen[-1]
            apart = np.minimum(apart, ((x - x[k]) ** 2).sum(axis=1) + (self.extra[some] - self.extra[some[k]]) ** 2)
            far = int(apart.argmax())
            if apart[far] <= 0:
                break
            chosen.append(far)
        return some[chosen].tolist()

    def route(self, q: np.ndarray, visit: Callable[[int, np.ndarray, np.ndarray], None] | None = None) -> np.ndarray:
        """The leaf of each row; ``visit`` gets node, distances and choices."""
        x, square = q.astype(np.float64), _lengths(q)
        extra = np.sqrt(np.maximum(self.most - square, 0))
        leaf = np.zeros(len(q), np.int64)
        todo = [(self.root, np.arange(len(q)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                leaf[rows] = ~at
            elif len(rows):
                d = self.nodes[at].distances(x[rows], square[rows], extra[rows])
                near = d.argmin(axis=1)
                if visit:
                    visit(at, d, near)
                todo += [(below, rows[near == j]) for j, below in enumerate(self.nodes[at].below)]
        return leaf

    def reach(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves that may hold scores in one of an anchor's windows (anchors by
        windows, inclusive; an empty window has low > high), as pairs (anchor
        row, leaf)."""
        square = _lengths(q)
        x, none = q.astype(np.float64), np.zeros(len(q))
        slack = 1e-6 * (np.sqrt(square) + math.sqrt(self.most)) + 1e-6
        base = (square + self.most)[:, None]
        inner = np.sqrt(np.maximum(base - 2.0 * high, 0)) - slack[:, None]
        outer = np.sqrt(np.maximum(base - 2.0 * low, 0)) + slack[:, None]
        open_ = low <= high
        pairs: list[tuple[np.ndarray, int]] = []
        todo = [(self.root, np.flatnonzero(open_.any(axis=1)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                pairs.append((rows, ~at))
                continue
            if not len(rows):
                continue
            node = self.nodes[at]
            d = node.distances(x[rows], square[rows], none[rows])
            for j, below in enumerate(node.below):
                if node.hi[0, j] < 0:
                    continue  # no row at all
                least = np.maximum(d - node.hi[:, j], node.lo[:, j] - d).max(axis=1)
                greatest = (d + node.hi[:, j]).min(axis=1)
                meets = ((least[:, None] <= outer[rows]) & (greatest[:, None] >= inner[rows]) & open_[rows]).any(axis=1)
                todo.append((below, rows[meets]))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([r for r, _ in pairs]), np.concatenate([np.full(len(r), leaf) for r, leaf in pairs])


def best(score: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``score`` its k highest fitting columns (all, if fewer), of
    equal ones the first: row and column numbers, in no order."""
    n = score.shape[1]
    if not fits.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if int(np.abs(score).max()) < (1 << 61) // max(1, n):
        rank = np.where(fits, score * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
        top = np.argpartition(rank, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), score.shape)
        row = np.repeat(np.arange(len(score)), top.shape[1])
        column = top.ravel()
        good = fits[row, column]
        return row[good], column[good]
    rows, columns = [], []
    for r in range(len(score)):
        some = np.flatnonzero(fits[r])
        some = some[np.argsort(-score[r, some], kind="stable")[:k]]
        rows.append(np.full(len(some), r))
        columns.append(some)
    return np.concatenate(rows), np.concatenate(columns)


def _raise_floor(tree: Tree, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> np.ndarray:
    """Lower ends of the windows, raised to the k-th best sample row in them."""
    low = low.copy()
    score = products(q, tree.sample)
    partner = ((labels[:, None] == tree.labels) == same) & (ids[:, None] != tree.ids)
    for w in range(low.shape[1]):
        fits = partner & (score >= low[:, w, None]) & (score <= high[:, w, None])
        enough = np.flatnonzero(fits.sum(axis=1) >= k)
        if len(enough):
            inside = np.where(fits[enough], score[enough], np.iinfo(np.int64).min)
            kth = np.partition(inside, inside.shape[1] - k, axis=1)[:, inside.shape[1] - k]
            low[enough, w] = kth
    return low


def _search_tile(rows: pa.Table, anchors: pa.Table, k: int, same: bool) -> pa.Table:
    """The k best rows of one chunk for each window of each anchor of a block."""
    empty = pa.table({"akey": pa.array([], pa.int64()), "w": pa.array([], pa.int64()), "id": pa.array([], pa.int64()),
                      "label": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    if not rows.num_rows or not anchors.num_rows:
        return empty
    rows = rows.sort_by([("id", "ascending"), ("label", "ascending"), ("key", "ascending")])
    dim, ids, labels = rows["dim"][0].as_py(), rows["id"].to_numpy(), rows["label"].to_numpy()
    q, found = _matrix(rows["q"], dim), [empty]
    for at in range(0, anchors.num_rows, ANCHORS_AT_ONCE):
        some = anchors.slice(at, ANCHORS_AT_ONCE)
        n = some.num_rows
        low, high = (_matrix(some[c], -1 if n else 1) for c in ("low", "high"))
        score = products(_matrix(some["q"], dim), q)
        partner = ((some["label"].to_numpy()[:, None] == labels) == same) & (some["id"].to_numpy()[:, None] != ids)
        for w in range(low.shape[1]):
            r, c = best(score, partner & (score >= low[:, w, None]) & (score <= high[:, w, None]), k)
            if len(r):
                found.append(pa.table({"akey": some["akey"].to_numpy()[r], "w": np.full(len(r), w), "id": ids[c], "label": labels[c], "score": score[r, c]}))
    return pa.concat_tables(found)


class Index:
    """All rows by leaf, and the trees that lead to them."""

    def __init__(self, spark: SparkSession, rows: DataFrame, trees: dict[int, Tree], tile_rows: int, tile_anchors: int):
        self.spark, self.rows, self.trees, self.tile_rows, self.tile_anchors = spark, rows, trees, tile_rows, tile_anchors
        sizes = rows.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per leaf
        self.sizes = {(r["dim"], r["leaf"]): r["n"] for r in sizes}

    def search(self, requests: DataFrame, k: int, same: bool) -> DataFrame:
        """``requests``: akey, id, label, dim, q and windows low and high (long
        arrays of one length for all; low > high: none).  Returns the k best
        rows per akey and window w with their place (from 1): akey, w, id,
        label, score, place."""
        shared = self.spark.sparkContext.broadcast(self.trees)

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column(3).to_numpy(zero_copy_only=False)
                for dim in np.unique(dims).tolist():
                    tree, mine = shared.value[dim], batch.filter(pa.array(dims == dim))
                    for at in range(0, mine.num_rows, ANCHORS_AT_ONCE):
                        some = mine.slice(at, ANCHORS_AT_ONCE)
                        q, low, high = _matrix(some.column(4), dim), _matrix(some.column(5), -1), _matrix(some.column(6), -1)
                        low = _raise_floor(tree, q, some.column(1).to_numpy(), some.column(2).to_numpy(), low, high, k, same)
                        row, leaf = tree.reach(q, low, high)
                        ends = pa.array(np.arange(0, low.size + 1, low.shape[1]), pa.int32())
                        out = [*some.columns[:5], pa.ListArray.from_arrays(ends, pa.array(low.ravel())), some.column(6)]
                        out = [c.take(pa.array(row)) for c in out]
                        yield pa.RecordBatch.from_arrays([*out, pa.array(leaf)], names=["akey", "id", "label", "dim", "q", "low", "high", "leaf"])

        columns = ["akey", "id", "label", "dim", "q", "low", "high"]
        asked = written(requests.select(*columns).mapInArrow(
            expand, "akey long, id long, label long, dim int, q array<long>, low array<long>, high array<long>, leaf long"), "hard-requests")
        wanted = asked.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per leaf
        plan = [(r["dim"], r["leaf"], -(-self.sizes.get((r["dim"], r["leaf"]), 1) // self.tile_rows), -(-r["n"] // self.tile_anchors)) for r in wanted]
        tiles = F.broadcast(self.spark.createDataFrame(plan, "dim int, leaf long, chunks long, blocks long"))
        one = F.lit(1).cast("long")

        def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
            """Rows with a part of their own, copied to every part of the other side."""
            parts = df.join(tiles, ["dim", "leaf"]).withColumn(own[:-1], F.pmod(F.xxhash64(key), F.col(own)))
            return parts.withColumn(other[:-1], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - one))).drop("chunks", "blocks")

        place = ["dim", "leaf", "chunk", "block"]
        left = dealt(self.rows, "key", "chunks", "blocks").groupBy(*place)
        right = dealt(asked, "akey", "blocks", "chunks").groupBy(*place)
        found = left.cogroup(right).applyInArrow(lambda a, b: _search_tile(a, b, k, same), "akey long, w long, id long, label long, score long")
        order = Window.partitionBy("akey", "w").orderBy(F.desc("score"), "id", "label")
        return written(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "hard-found")


def build_index(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
                sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, fan: int = FAN, tile_rows: int = TILE_ROWS, tile_anchors: int = TILE_ANCHORS) -> Index:
    """Index all rows that take part."""
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
                      & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)))
    rows = rows.select("id", "label", F.size(v).alias("dim"), scaled.alias("q"))
    bound = float(1 << 27) / F.sqrt(F.greatest(F.col("dim"), F.lit(1)))
    rows = rows.where(F.forall("q", lambda x: F.abs(x.cast("double")) <= bound))
    rows = rows.withColumns({"k1": F.xxhash64("q"), "k2": F.xxhash64(F.lit(11), "q")})
    rows = rows.groupBy("id", "label", "dim", "k1", "k2").agg(F.first("q").alias("q"))
    rows = written(rows.select(F.xxhash64("id", "label", "k1", "k2").alias("key"), "id", "label", "dim", "q"), "hard-rows")

    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    stats = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("most")).collect()  # one row per vector length
    drawn = (rows.withColumn("draw", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64(F.lit(11), "key"), "key")))
             .where(F.col("draw") <= sample).drop("draw").toArrow())
    trees: dict[int, Tree] = {}
    dims = drawn["dim"].to_numpy()
    for r in stats:
        some = drawn.filter(pa.array(dims == r["dim"])).sort_by("key")
        trees[r["dim"]] = Tree(r["most"] or 0.0, r["n"], _matrix(some["q"], r["dim"]), some["id"].to_numpy(), some["label"].to_numpy(), leaf_rows, fan)

    shared = spark.sparkContext.broadcast(trees)

    def split(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        dims = batch.column(3).to_numpy(zero_copy_only=False)
        for dim in np.unique(dims).tolist():
            yield dim, batch.filter(pa.array(dims == dim))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, mine in split(batch):
                leaf = shared.value[dim].route(_matrix(mine.column(4), dim))
                yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(leaf)], names=["key", "id", "label", "dim", "q", "leaf"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distance ranges of a task's rows, one row per split point and sibling."""
        seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, mine in split(batch):
                def visit(at: int, d: np.ndarray, near: np.ndarray, dim=dim) -> None:
                    f = d.shape[1]
                    lo, hi = seen.setdefault((dim, at), (np.full((f, f), np.inf), np.full((f, f), -np.inf)))
                    for j in np.unique(near).tolist():
                        lo[:, j] = np.minimum(lo[:, j], d[near == j].min(axis=0))
                        hi[:, j] = np.maximum(hi[:, j], d[near == j].max(axis=0))

                shared.value[dim].route(_matrix(mine.column(4), dim), visit)
        for (dim, at), (lo, hi) in seen.items():
            i, j = np.nonzero(hi >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), x), pa.int64()) for x in (dim, at)] + [pa.array(x) for x in (i, j, lo[i, j], hi[i, j])],
                                             names=["dim", "node", "i", "j", "lo", "hi"])

    placed = written(rows.mapInArrow(route, f"{_ROWS}, leaf long"), "hard-leaves")
    stored = (placed.drop("leaf").mapInArrow(ranges, "dim long, node long, i long, j long, lo double, hi double")
              .groupBy("dim", "node", "i", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())  # bounded by the sample
    for r in stored:
        node = trees[r["dim"]].nodes[r["node"]]
        node.lo[r["i"], r["j"]], node.hi[r["i"], r["j"]] = r["lo"], r["hi"]
    return Index(spark, placed, trees, tile_rows, tile_anchors)


def mine_negatives(index: Index, is_anchor: Column, *, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """For every anchor (rows whose ``id`` satisfies ``is_anchor``) and each of
    its first ``positives`` rows of the same label, the first ``negatives``
    rows of other labels that score from ``low`` to ``high`` percent of the
    positive: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score."""
    anchors = index.rows.where(is_anchor).select(F.col("key").alias("akey"), "id", "label", "dim", "q")
    whole = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("low", _LOW), ("high", _HIGH))]
    near = index.search(anchors.select("*", *whole), positives, same=True)
    near = near.select("akey", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("place").alias("positive_place"))
    # One window per positive, by its place; a negative score has none.
    score = [F.max(F.when(F.col("positive_place") == p + 1, F.col("positive_score"))) for p in range(positives)]
    per = near.groupBy("akey").agg(F.array(*score).alias("scores"))
    windows = per.select("akey", F.expr(f"transform(scores, s -> if(s >= 0, (s * {low:d} + 99) div 100, 1L))").alias("low"),
                         F.expr(f"transform(scores, s -> if(s >= 0, (s * {high:d}) div 100, 0L))").alias("high"))
    asked = anchors.join(windows, "akey")
    found = index.search(asked, negatives, same=False)
    found = found.select("akey", (F.col("w") + 1).cast("int").alias("positive_place"), F.col("place").cast("int").alias("rank"),
                         F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (near.join(found, ["akey", "positive_place"]).join(anchors.select("akey", F.col("id").alias("anchor_id")), "akey")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
