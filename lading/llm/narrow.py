"""Which rows of a wide table may match a list of keys, told without a shuffle
of the table, so that only those need an exact join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits that keys are hashed to.  They bound what is broadcast, whatever the
#: number of keys: a row of two longs for each 64 of them at most.
SLOTS = 1 << 25


def may_match(rows: DataFrame, col: str, keys: DataFrame, flag: str) -> DataFrame:
    """``rows`` with the boolean column ``flag``: true for every row whose
    ``col`` is in the column ``col`` of ``keys``, and by chance for others (a
    share of distinct keys / ``SLOTS`` at most).  Rows stay where they are.
    The names ``flag``, ``{flag}_word`` and ``{flag}_bits`` must be free in
    ``rows``; nulls get either value."""
    word, bits = f"{flag}_word", f"{flag}_bits"
    slot = f"pmod(xxhash64(`{col}`), {SLOTS}L)"
    place = f"cast({slot} & 63L as int)"
    words = keys.select(F.expr(f"shiftright({slot}, 6)").alias(word), F.expr(f"shiftleft(1L, {place})").alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    met = rows.withColumn(word, F.expr(f"shiftright({slot}, 6)")).join(F.broadcast(words), word, "left")
    return met.withColumn(flag, F.expr(f"coalesce(shiftrightunsigned(`{bits}`, {place}) & 1L, 0L) = 1L")).select(*rows.columns, flag)
