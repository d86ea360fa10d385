"""Keyed upsert: full-row replace by key, later rows win, nothing deleted.

* Rows of the new batch with a complete key are reduced to one row per key —
  the one with the highest ordering value (file rank, line).  This is a
  ``groupBy().agg(max(struct(order, row)))``: partial aggregation runs before the shuffle, so a
  key repeated a million times shuffles one row per map task.
* A key with a NULL part never conflicts: such rows bypass both the reduction
  and the join and are appended (old ones kept, new ones added).  Keeping them
  out of the join also keeps the NULL-key rows from piling up in one shuffle
  partition.
* Old rows whose key appears in the new batch are dropped (left anti join);
  all other old rows stay — feeds never delete.
* A replaced row takes the new row whole: columns the new file lacks are NULL.
* A keyless table only appends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete_key(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])


def last_wins(new: DataFrame, key: list[str], order_cols: list[str]) -> DataFrame:
    """One row per complete key (highest ``order_cols`` wins); rows with a
    NULL key part are kept as they are."""
    if not key:
        return new
    payload = [c for c in new.columns if c not in key]
    keyed = new.where(complete_key(key))
    nulls = new.where(~complete_key(key))
    if not payload:
        return keyed.dropDuplicates(key).unionByName(nulls)
    # max over (order, payload): the order struct decides; one aggregate
    # buffer per key, combined map-side before the shuffle.
    best = keyed.groupBy(*key).agg(
        F.max(F.struct(F.struct(*order_cols).alias("_o"), *payload)).alias("_row")
    )
    reduced = best.select(*key, *[F.col("_row")[c].alias(c) for c in payload])
    return reduced.select(*new.columns).unionByName(nulls)


def upsert(old: DataFrame, new: DataFrame, key: list[str],
           order_cols: list[str] | None = None, keep_cols: list[str] | None = None,
           new_is_unique: bool = False) -> DataFrame:
    """``old`` with ``new`` applied.  ``new`` may carry ordering columns
    (``order_cols``) that are not part of the table; they are dropped after
    the reduction.  ``new_is_unique``: the caller guarantees one new row per
    key (e.g. one control row per planned file), so the reduction is
    skipped.  Output columns: ``old``'s, in its order."""
    cols = keep_cols or old.columns
    if not key:
        return old.select(*cols).unionByName(new.select(*cols))
    reduced = (new if new_is_unique else last_wins(new, key, order_cols or [])).select(*cols)
    old_c = old.select(*cols)
    old_null = old_c.where(~complete_key(key))
    old_keyed = old_c.where(complete_key(key)).join(
        reduced.where(complete_key(key)).select(*key), key, "left_anti"
    )
    return old_keyed.unionByName(old_null).unionByName(reduced)


def upsert_latest(old: DataFrame, new: DataFrame, key: list[str], order_cols: list[str],
                  keep_cols: list[str] | None = None) -> DataFrame:
    """Upsert where the row with the highest ``order_cols`` wins across old
    and new alike — for sources whose batches may arrive out of order (a
    stream of files).  The order columns must be table columns."""
    cols = keep_cols or old.columns
    return last_wins(old.select(*cols).unionByName(new.select(*cols)), key, order_cols)
