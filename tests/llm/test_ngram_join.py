import re


from lading.llm import ngram_join as N
from tests_llm_prose import SF_SMALL, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                i, j = sorted((root(rows[a][0]), root(rows[b][0])))
                parent[j] = i
    return sorted(((i, len(sets[k]), links[k], None if i is None else root(i)) for k, (i, _) in enumerate(rows)), key=str)


def near(text, seed, edits):
    import random

    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"edit{r.randrange(10 ** 6)}"
    return " ".join(w)


def test_matches_brute_force(spark, documents):
    rows = [(k, prose(k, 40 + 13 * k)) for k in range(20)]
    for k in range(60):
        rows.append((100 + k, near(rows[k % 12][1], k, k % 7)))
    rows += [(300, rows[3][1].upper()), (301, rows[3][1].replace(" ", "\t\n")), (302, rows[3][1]), (302, rows[3][1])]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "one two"), (404, "ONE two"), (405, "one"), (406, "one two x y"), (None, rows[3][1])]
    for n, percent, tile, bucket_tile in ((4, 85, 512, 4096), (5, 80, 2, 3)):
        got = [tuple(r) for r in N.ngram_join(documents(rows), n=n, percent=percent, tile=tile, bucket_tile=bucket_tile).collect()]
        assert sorted(got, key=str) == brute(rows, n, percent)


def test_bitmap_bound_never_loses_a_pair():
    import numpy as np

    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, k, replace=False), r.integers(0, 1 << 63, 10, dtype=np.uint64)])) for k in (5, 300, 3300, 3900, 3950, 4000)]
    found = {(min(i, int(j)), max(i, int(j))) for i, js in N.tile_links(sets, np.zeros(6, int), 85, True) for j in js}
    want = {(a, b) for a in range(6) for b in range(a + 1, 6) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert found == want and want


def test_tiles_by_bytes(spark, documents, monkeypatch):
    rows = [(k, near(prose(1, 200), k, k % 9)) for k in range(40)]
    monkeypatch.setattr(N, "TILE_BYTES", 6_000)
    got = [tuple(r) for r in N.ngram_join(documents(rows), n=4, percent=85).collect()]
    assert sorted(got, key=str) == brute(rows, 4, 85)


def test_bucket_links_are_the_components_of_near_signatures():
    import numpy as np

    r = np.random.default_rng(2)
    for trial in range(30):
        m = int(r.integers(2, 60))
        ends = np.repeat(*(lambda c: (c, np.diff(c, prepend=0)))(np.unique(np.append(r.integers(1, m + 1, 4), m))))
        base = r.integers(0, 1 << 63, (3, 2), dtype=np.uint64)
        signs = base[r.integers(0, 3, m)] ^ (np.uint64(1) << r.integers(0, 63, (m, 2)).astype(np.uint64))
        side = r.integers(0, 2, m) if trial % 2 else np.full(m, -1)
        size = r.integers(90, 120, m)
        label = N.bucket_links(ends, side, size, signs, 85, 3)
        want = list(range(m))
        for _ in range(m):
            for i in range(m):
                for j in range(i + 1, int(ends[i])):
                    near_by = sum(bin(int(a ^ b)).count("1") for a, b in zip(signs[i], signs[j])) <= 3
                    if near_by and (side[i] < 0 or side[i] != side[j]) and 100 * min(size[i], size[j]) >= 85 * max(size[i], size[j]):
                        want[i] = want[j] = min(want[i], want[j])
        assert label.tolist() == want


def test_batch_borders_do_not_cut_buckets():
    import numpy as np
    import pyarrow as pa

    r = np.random.default_rng(3)
    key = np.sort(r.integers(0, 12, 300))
    rep = r.permutation(300).astype(np.int64)
    signs = r.integers(0, 1 << 63, (12, 1), dtype=np.uint64)[key]
    zero = np.zeros(300, np.int64)
    t = pa.table({"rep": rep, "key": key, "n": zero + 50, "sign": pa.array([s.tobytes() for s in signs], pa.binary()), "lt": zero, "rt": zero, "side": (zero - 1).astype(np.int32)})
    want = {(int(i), int(rep[key == k].min())) for i, k in zip(rep, key)} - {(i, i) for i in range(300)}
    for rows in (1, 7, 64, 300):
        out = [b for b in N._walk_buckets(iter(t.to_batches(max_chunksize=rows)), 85, 3)]
        assert {(a, b) for o in out for a, b in zip(o["a"].to_pylist(), o["b"].to_pylist())} == want


def test_pages_of_one_template_are_not_chained(spark):
    """4,000 texts that share half their words each: buckets meet by chance, but
    no pair is compared exactly."""
    import random

    from pyspark.sql import functions as F

    common = prose(5, 60)
    rows = []
    for k in range(4_000):
        r = random.Random(k)
        rows.append((k, common + " " + " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    bands = 69
    sets = N.set_tables(docs, "doc_id", "text", 5, N.ROWS, bands).withColumnRenamed("id", "rep")
    shared = sets.select("rep", F.explode("bands").alias("key")).groupBy("key").count().where("count > 1")
    assert shared.agg(F.max("count")).first()[0] > 100
    assert N._near_in_buckets(sets, 80, N.most_apart(N.ROWS * bands, 80, N.MISS), 4096).count() == 0


def test_only_texts_that_may_link_meet_the_tiles(spark, documents):
    docs = documents([(k, prose(k, 40)) for k in range(200)])
    near_by = N._texts_near(docs, "doc_id", "text", docs.where("doc_id < 9").selectExpr("doc_id as rep")).collect()
    assert {r.rep for r in near_by} >= set(range(9)) and len(near_by) < 12


def test_signature_bound():
    """No more bits may differ than a linked pair's, with a margin on both sides."""
    from math import comb

    for count, percent in ((414, 80), (264, 85)):
        p, apart = (1 + percent / 100) / 2, N.most_apart(count, percent, N.MISS)
        lost = sum(comb(count, k) * p ** (count - k) * (1 - p) ** k for k in range(apart + 1, count + 1))
        assert 1e-13 < lost <= N.MISS


def test_empty_table(documents):
    assert N.ngram_join(documents([])).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in N.ngram_join(docs, n=4, percent=85).collect()]
    assert sorted(got, key=str) == brute(rows, 4, 85)
