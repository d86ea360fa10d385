"""Row positions, batches, resume offsets and the row budget.

Positions are never computed with one window over a whole file: a file may
hold a third of all rows, and a window partitioned by file would sort it in
one task.  Instead rows are range-partitioned (or kept in their file splits),
each partition counts its rows per group, a window runs over those counts —
one row per (partition, group), a table whose size is bounded by the number of
partitions — and the offsets are joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Splits whose offsets may be broadcast (some 100 bytes each); beyond it the
#: offsets are joined by a shuffle.
BROADCAST_SPLITS = 200_000

_LOW33 = (1 << 33) - 1  # monotonically_increasing_id: record number in its partition


def _offsets(counts: DataFrame, group_cols: list[str], order_cols: list[str], out: str) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return counts.withColumn(out, F.coalesce(F.sum("_n").over(w), F.lit(0)))


def number_rows(df: DataFrame, group_cols: list[str], order_cols: list[str],
                out: str = "row_no", num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row within its group, in ``order_cols`` order.

    The order must be total within a group (ties get an arbitrary order).
    Rows are range-partitioned on ``group_cols + order_cols``, so a hot group
    spreads over many tasks; per-partition counts give each partition's start
    offset within the group.
    """
    from lading.session import shared_dir

    shared_dir(df.sparkSession)  # the checkpoint folder must be known
    keys = group_cols + order_cols
    parts = (
        df.repartitionByRange(num_partitions, *keys)
        if num_partitions
        else df.repartitionByRange(*keys)
    )
    # Range bounds come from sampling, so two evaluations of the partitioning
    # may cut differently; the counts and the rows must see the same one.
    # A reliable checkpoint (in spark.checkpoint.dir) fixes it once.
    local = (
        parts.sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_rec", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
        .checkpoint(eager=True)
    )
    counts = local.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rec").alias("_first")
    )
    offs = _offsets(counts, group_cols, ["_pid"], "_off").select("_pid", *group_cols, "_off", "_first")
    return (
        local.join(offs, ["_pid", *group_cols], "inner")
        .withColumn(out, F.col("_off") + F.col("_rec") - F.col("_first") + 1)
        .drop("_pid", "_rec", "_off", "_first")
    )


def number_in_storage_order(rows: DataFrame, group_cols: list[str],
                            out: str = "line_no") -> DataFrame:
    """Position of each row within its group, in the order the rows are
    stored.

    ``rows`` must come straight from a file scan (filters allowed, no
    shuffle) and carry ``_path`` and ``_block`` (``_metadata.file_path`` and
    ``_metadata.file_block_start``); a group's rows must be stored in order
    across its files and splits ordered by (path, block start).  A task reads
    one split in order, so only per-split counts are shuffled: a window runs
    over one row per (group, split).  The counts are written once; up to
    ``BROADCAST_SPLITS`` of them reach the scan stage as a lookup, so that the rows
    themselves are not exchanged.
    """
    from lading.session import scratch_path

    spark = rows.sparkSession
    # Part files are ordered by the number in their name (part-100000 comes
    # after part-99999), other files by name.
    rows = rows.withColumn("_part", F.expr(r"try_cast(regexp_extract(_path, 'part-([0-9]+)[^/]*$', 1) as bigint)"))
    local = rows.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_rec", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))
    )
    split_cols = ["_part", "_path", "_block"]
    counts = local.groupBy(*group_cols, *split_cols, "_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rec").alias("_first")
    )
    # The counts come from a scan cut in the same splits as the rows' own.
    path = scratch_path(spark, "split-offsets")
    offs = _offsets(counts, group_cols, split_cols, "_off").drop("_n", "_part")
    offs.write.parquet(path)
    offs = spark.read.schema(offs.schema).parquet(path)
    if offs.count() <= BROADCAST_SPLITS:
        offs = F.broadcast(offs)
    keys = [*group_cols, "_path", "_block", "_pid"]
    offs = offs.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    met = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    # A split cut otherwise than when it was counted has no offset: an error, not a lost row.
    off = F.coalesce("_off", F.raise_error(F.lit("the splits changed between counting and numbering")).cast("long"))
    return (
        local.join(offs, met, "left")
        .withColumn(out, off + F.col("_rec") - F.col("_first") + 1)
        .drop("_pid", "_rec", "_off", "_first", "_part", *[f"_of_{k}" for k in keys])
    )


def number_text_lines(text: DataFrame, group_col: str = "file",
                      out: str = "line_no") -> DataFrame:
    """Line numbers of a text source read with :func:`read_text_lines`:
    lines of a logical file (``group_col``; by default the physical file)
    numbered across its files and splits in (path, block start) order."""
    return number_in_storage_order(text, [group_col], out)


def read_text_lines(spark, path: str, group_col: Column | None = None) -> DataFrame:
    """``spark.read.text`` with the split metadata kept for numbering."""
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    return raw.withColumn("file", group_col if group_col is not None else F.col("_path"))


def batch_number(row_no, size: int = 500) -> Column:
    """Batch of a row: groups of ``size`` consecutive rows, from 0."""
    r = F.col(row_no) if isinstance(row_no, str) else row_no
    return F.floor((r - 1) / F.lit(size)).cast("long")


def after_offset(df: DataFrame, offsets: DataFrame, keys: list[str],
                 line_col: str = "line_no", offset_col: str = "offset") -> DataFrame:
    """Rows past the resume offset of their file.  ``offsets`` is the per-file
    plan (one row per file); files without a row are not read."""
    return df.join(offsets.select(*keys, offset_col), keys, "inner").where(
        F.col(line_col) > F.col(offset_col)
    )


def file_quotas(file_counts: DataFrame, budget: int, provider_col: str = "provider",
                file_col: str = "file", rows_col: str = "rows") -> DataFrame:
    """Share a per-provider row budget across files in file-name order.

    ``file_counts``: one row per file with the rows it has to offer.  Adds
    ``taken_before`` (rows granted to earlier files), ``quota`` (rows this file
    may take) and ``file_done`` (the file is taken to its end).
    """
    before = rows_before(file_counts, [provider_col], [file_col], rows_col, "_before")
    return (
        before.withColumn("taken_before", F.least("_before", F.lit(budget)).cast("long"))
        .withColumn(
            "quota",
            F.least(F.col(rows_col), F.greatest(F.lit(budget) - F.col("taken_before"), F.lit(0))).cast("long"),
        )
        .withColumn("file_done", F.col("quota") >= F.col(rows_col))
        .drop("_before")
    )


def rows_before(counts: DataFrame, group_cols: list[str], order_cols: list[str], rows_col: str, out: str) -> DataFrame:
    """Sum of ``rows_col`` over the earlier rows of the group, in two levels: rows
    are range-partitioned, so a group (a provider with a million files) spreads
    over tasks; sums per partition give each partition's start, and only the
    rows of one partition and group are summed in order."""
    from lading.session import shared_dir

    shared_dir(counts.sparkSession)  # the checkpoint folder must be known
    keys = group_cols + order_cols
    # Range bounds come from sampling: fixed once, by a reliable checkpoint.
    local = counts.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    sums = local.groupBy("_pid", *group_cols).agg(F.sum(rows_col).alias("_n"))
    starts = _offsets(sums, group_cols, ["_pid"], "_start").select("_pid", *group_cols, "_start")
    inside = Window.partitionBy("_pid", *group_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (
        local.withColumn("_inside", F.coalesce(F.sum(rows_col).over(inside), F.lit(0)))
        .join(starts, ["_pid", *group_cols], "inner")
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_pid", "_start", "_inside")
    )
