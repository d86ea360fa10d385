"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest length is cut into fragments of it; nothing
is dropped.  Fragments are dealt evenly to shards of about ``SHARD_ITEMS`` (the
number of shards follows the number of fragments), and each shard is packed on
its own, so a task holds one small shard whatever the corpus.

In a shard fragments go by falling length.  Each goes to the open bin with the
least room that still fits it.  If none fits, a bin is opened whose length
costs least per token: for every permitted length the bin is filled in trial
with the longest fragments still to come, and the cost after downsizing is
divided by the tokens placed.  At the end each bin is downsized to the smallest
permitted length that holds its contents.

Null and empty texts have no tokens: one row with part 0 and no bin.  Rows with
a null or repeated id are separate documents; ties go by id and part.  Extra
columns are ignored; an empty table gives no rows.

``pack_documents`` takes the lengths it is given; ``pack_by_tokens`` counts
them with a public tokenizer first, so that no bin exceeds its capacity.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.llm.graph import written
from lading.llm.token_counts import count_tokens
from lading.session import ship_package

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Default cost of a sequence of n positions, in tokens: n, plus n squared over
#: ``ATTENTION`` (attention), plus ``OVERHEAD`` (launch).
ATTENTION, OVERHEAD = 32_768, 32
SHARD_ITEMS = 4096


def token_estimate(text: Column) -> Column:
    """Tokens of a text at four UTF-8 bytes a token, rounded up."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def pack(lengths: Iterable[int], costs: dict[int, float]) -> tuple[list[int], list[int], list[int]]:
    """Pack positive lengths (given by falling length, none above the largest
    capacity).  Returns, per item, its bin and its offset there, and, per bin,
    its final capacity."""
    lengths = list(lengths)
    caps = sorted(costs)
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    sizes = sorted(left)  # distinct lengths still to come

    def final(used: int) -> int:
        return caps[bisect_left(caps, used)]

    def trial(cap: int, first: int) -> int:
        """Tokens in a new bin of ``cap`` filled from what is to come."""
        used, k = first, len(sizes)
        while k:
            k = bisect_right(sizes, cap - used, 0, k)
            if not k:
                break
            n = sizes[k - 1]
            used += n * min(left[n], (cap - used) // n)
            k -= 1
        return used

    open_bins: list[tuple[int, int]] = []  # (room, bin), sorted
    room: list[int] = []
    caps_open: list[int] = []
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i, n in enumerate(lengths):
        left[n] -= 1
        if not left[n]:
            del left[n]
            sizes.pop(bisect_left(sizes, n))
        k = bisect_left(open_bins, (n, -1))
        if k < len(open_bins):
            _, b = open_bins.pop(k)
        else:
            def cost(cap: int, n: int = n) -> tuple[float, int]:
                used = trial(cap, n)
                return costs[final(used)] / used, cap

            cap = min((c for c in caps if c >= n), key=cost)
            b = len(room)
            room.append(cap)
            caps_open.append(cap)
        where[i], offset[i] = b, caps_open[b] - room[b]
        room[b] -= n
        if room[b]:
            insort(open_bins, (room[b], b))
    return where, offset, [final(c - r) for c, r in zip(caps_open, room, strict=True)]


def _pack_shard(table: pa.Table, costs: dict[int, float]) -> pa.Table:
    table = table.sort_by([("n_tokens", "descending"), ("id", "ascending"), ("part", "ascending")])
    where, offset, caps = pack(table["n_tokens"].to_pylist(), costs)
    where = np.asarray(where, np.int64)
    shard = table["shard"].to_numpy()
    return pa.table({
        "id": table["id"], "part": table["part"], "start": table["start"], "n_tokens": table["n_tokens"],
        "bin_id": shard * (1 << 20) + where, "bin_offset": np.asarray(offset, np.int64),
        "bin_capacity": np.asarray(caps, np.int64)[where]})


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
                   capacities: tuple[int, ...] = CAPACITIES, costs: dict[int, float] | None = None,
                   shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per fragment: the id, part, start and n_tokens (the fragment's
    tokens in its document), bin_id, bin_offset and bin_capacity.  ``length``
    gives a document's tokens (default: an estimate from its bytes); ``costs``
    gives the cost of each permitted length (default: as ``ATTENTION`` says)."""
    ship_package(docs.sparkSession)
    costs = costs or {c: c + c * c / ATTENTION + OVERHEAD for c in capacities}
    top = max(costs)
    tokens = token_estimate(F.col(text_col).cast("string")) if length is None else F.coalesce(length.cast("long"), F.lit(0))
    sized = docs.select(F.col(id_col).cast("long").alias("id"), tokens.alias("all"))
    parts = sized.where("all > 0").select("id", "all", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / top))).alias("part"))
    parts = parts.select("id", "part", (F.col("part") * top).alias("start"), F.least(F.lit(top), F.col("all") - F.col("part") * top).alias("n_tokens"))
    count = sized.where("all > 0").agg(F.sum(F.floor((F.col("all") - 1) / top) + 1)).first()[0] or 0
    shards = max(1, -(-int(count) // shard_items))
    # The row's place joins the hash, so repeated ids spread as well.
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("id", "part", F.monotonically_increasing_id()), F.lit(shards)).cast("long"))
    schema = "id long, part long, start long, n_tokens long, bin_id long, bin_offset long, bin_capacity long"
    packed = dealt.groupBy("shard").applyInArrow(lambda t: _pack_shard(t, costs), schema)
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    empty = sized.where("all <= 0").select("id", zero.alias("part"), zero.alias("start"), zero.alias("n_tokens"),
                                           none.alias("bin_id"), none.alias("bin_offset"), none.alias("bin_capacity"))
    return packed.unionByName(empty).withColumnRenamed("id", id_col)


def pack_by_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str = "word_bpe_49k.json", **options) -> DataFrame:
    """``pack_documents`` over the tokens that ``vocabulary`` gives each text.
    Starts and lengths count those tokens, so long texts are cut between two of
    them.  Texts are encoded once: the counts are a written table."""
    counted = written(count_tokens(docs, id_col=id_col, text_col=text_col, vocabulary=vocabulary).select(id_col, "n_tokens"), "packing-tokens")
    return pack_documents(counted, id_col=id_col, length=F.col("n_tokens"), **options)
