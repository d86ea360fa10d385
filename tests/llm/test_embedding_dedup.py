import numpy as np

from lading.llm.embedding_dedup import near_vectors, plan, share_chance

SCHEMA = "vec_id long, embedding array<float>, n_links string, good string"


def brute(rows):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None for x in v) and np.isfinite(v).all() and np.any(v)]
    parent = {i: i for i, _ in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {k: 0 for k in range(len(good))}
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95:
                links[a] += 1
                links[b] += 1
                i, j = sorted((root(good[a][0]), root(good[b][0])))
                parent[j] = i
    out = [(i, links[k], root(i), root(i) == i) for k, (i, _) in enumerate(good)]
    bad = [(i, 0, i, True) for i, v in rows if not any(i == g and np.array_equal(v, w.astype(np.float32)) for g, w in good if v is not None and i is not None and None not in v)]
    return sorted(out + bad, key=str)


def test_matches_brute_force(spark):
    r = np.random.default_rng(3)
    rows = []
    for c in range(12):
        base = r.standard_normal(24)
        for k in range(1 + c):
            rows.append((len(rows), [float(np.float32(x)) for x in base + 0.12 * k ** 0.5 * r.standard_normal(24)]))
    rows += [(500, rows[30][1]), (501, rows[30][1]), (502, [2 * x for x in rows[30][1]])]
    rows += [(600, None), (601, [0.0] * 24), (602, [float("nan")] * 24), (603, [None] * 24), (604, []), (605, [float("inf")] + [1.0] * 23), (606, [1.0, 0.0]), (607, [1.0, 0.0078125]), (None, rows[30][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    for tile in (128, 3):
        got = near_vectors(df, tile=tile).collect()
        assert sorted([tuple(g) for g in got], key=str) == brute(rows)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_reaches_its_recall_at_every_size():
    for rows in (1, 100, 10_000, 10**9):
        projections, tables = plan(rows, 0.95, 2.0, 0.2, 1e-3)
        miss = (1 - share_chance(0.1 ** 0.5, 2.0) ** projections) ** tables
        assert miss <= 1e-3
        assert rows * share_chance(2 ** 0.5, 2.0) ** projections <= 0.2 or rows <= 1
