import random
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from lading.llm.packing import CAPACITIES, pack, pack_documents
from lading.llm.queries import QUERIES
from lading.llm.token_counts import vocabulary_path
from tests_llm_prose import SF_SMALL


def check(lengths, costs):
    where, offset, caps = pack(lengths, costs)
    bins = defaultdict(list)
    for n, b, o in zip(lengths, where, offset, strict=True):
        bins[b].append((o, n))
    assert sorted(bins) == list(range(len(caps)))
    for b, items in bins.items():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert caps[b] == min(c for c in costs if c >= at)
    return sum(costs[c] for c in caps)


@pytest.mark.parametrize("seed", range(5))
def test_bins_hold_every_item_once_at_the_least_size(seed):
    r = random.Random(seed)
    costs = {16: 17.0, 64: 70.0, 256: 300.0}
    lengths = sorted((min(256, int(r.expovariate(1 / 40)) + 1) for _ in range(600)), reverse=True)
    assert check(lengths, costs) <= 1.12 * min(c / k for k, c in costs.items()) * sum(lengths) + costs[256]


def test_equal_lengths_and_exact_fits():
    assert check([8] * 64, {16: 16.0, 64: 64.0}) == 512
    assert check([], {16: 16.0}) == 0


def test_documents(spark):
    rows = [(1, "x" * 100), (1, "x" * 100), (None, "y" * 9), (2, None), (3, ""), (4, "z" * 4 * 20_000)] + [(10 + k, "a" * (k * 37 % 3000)) for k in range(300)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bin_id string")
    got = pack_documents(docs, shard_items=100).collect()
    need = sorted((i if i is not None else -1, -(-len(t or "") // 4)) for i, t in rows)
    have = defaultdict(int)
    for r in got:
        have[r.doc_id] += r.n_tokens
    total = defaultdict(int)
    for i, n in need:
        total[None if i == -1 else i] += n
    assert have == total
    bins = defaultdict(list)
    for r in got:
        if r.n_tokens == 0:
            assert r.bin_id is None
            continue
        bins[r.bin_id, r.bin_capacity].append((r.bin_offset, r.n_tokens))
    for (_, cap), items in bins.items():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert cap == min(c for c in CAPACITIES if c >= at)
    long = sorted((r.part, r.start, r.n_tokens) for r in got if r.doc_id == 4)
    assert long == [(0, 0, 8192), (1, 8192, 8192), (2, 16384, 3616)]
    assert len({b for b, _ in bins}) == len(bins)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("packing", [QUERIES["op6_best_fit_packing"], lambda spark, sf: P.packing(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)])
def test_registered_packings_hold_real_tokens(spark, packing):
    tok = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    need = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False)) for r in docs}
    assert len(need) == len(docs)
    have, bins, size = defaultdict(int), defaultdict(int), {}
    for r in packing(spark, SF_SMALL).collect():
        assert r.start == 8192 * r.part
        have[r.doc_id] += r.n_tokens
        bins[r.bin_id] += r.n_tokens
        size[r.bin_id] = r.bin_capacity
    assert have == need
    assert all(size[b] is None or n <= size[b] for b, n in bins.items())
