import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lading.llm import hard_negatives as H

COLUMNS = "vec_id long, label int, embedding array<double>, rank string, key string, leaf string, score string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], COLUMNS)


def brute(rows, anchors, positives=5, negatives=3):
    clean = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * x) for x in v)
        if all(abs(x) <= (1 << 27) / math.sqrt(max(1, len(q))) for x in q):
            clean[i, label, q] = True
    clean = list(clean)
    out = []
    for i, label, q in clean:
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, r, strict=True)), j, other) for j, other, r in clean if j != i and len(r) == len(q))
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, k + 1, h[1], -s, -h[0]) for k, h in enumerate(hard)]
    return sorted(out)


def found(index, anchor=None):
    got = H.mine_negatives(index, F.col("id") % 50 == 0 if anchor is None else anchor)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def clustered(n, dim, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((12, dim))
    x = centre[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, dim))
    return [(int(i), int(rng.integers(0, 4)), v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]


@pytest.mark.parametrize("sizes", [{}, {"leaf_rows": 40, "fan": 4, "tile_rows": 16, "tile_anchors": 3, "sample": 300}])
def test_equals_brute_force(spark, sizes):
    rows = clustered(900, 8, 1)
    assert found(H.build_index(make(spark, rows), **sizes)) == brute(rows, lambda i: i % 50 == 0)


def test_bad_rows_ties_repeats_and_other_lengths(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(200)]
    rows += [(50, 50 % 3, rows[50][2]), (50, 1, [0.5, 0.5, 0.0, 1.0]), (7, 7 % 3, rows[7][2])]  # repeats, and an id with two rows
    rows += [(300, None, [1.0] * 4), (350, 1, None), (400, 1, [1.0, None, 0.0, 0.0]), (450, 1, [1.0, math.nan, 0.0, 0.0]),
             (500, 1, [1.0, math.inf, 0.0, 0.0]), (550, 1, [1e300, 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (600, 1, []), (601, 1, []), (602, 2, []),
             (650, 1, [1.0, 2.0]), (651, 1, [1.0, 1.0]), (652, 2, [1.0, 0.5]), (700, 2, [0.0] * 4)]
    rows += [(1000 + i, i % 2, [0.25, 0.5, 0.75, 1.0]) for i in range(120)]  # a large group of copies
    for sizes in ({}, {"leaf_rows": 30, "fan": 3, "tile_rows": 10, "tile_anchors": 2}):
        assert found(H.build_index(make(spark, rows), **sizes)) == brute(rows, lambda i: i % 50 == 0)


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [float(2**18 + i), float(i * i)]) for i in range(60)]
    assert found(H.build_index(make(spark, rows)), F.col("id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def test_the_tree_eliminates_leaves(spark):
    rows = clustered(3000, 4, 3, spread=0.05)
    index = H.build_index(make(spark, rows), leaf_rows=60)
    tree = index.trees[4]
    q = np.floor(256 * np.array([r[2] for r in rows[:50]])).astype(np.int64)
    score = q @ tree.sample.T
    low = np.sort(score, axis=1)[:, -5:-4]
    row, _ = tree.reach(q, low, np.full_like(low, H._HIGH))
    assert tree.leaves > 20 and len(row) < 0.5 * 50 * tree.leaves


def test_empty_table(spark):
    assert found(H.build_index(make(spark, []))) == []
