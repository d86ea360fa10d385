"""Decisions and control-table operators: version change, provider gate,
per-file resume state, progress open/close/rollback, incomplete counts and
run metrics.  Control tables have one row per provider or per file, so their
joins are against small sides; feed rows never pass through here except as
per-file aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.functions.names import saturating_sub
from lading.operators.upsert import upsert

STATUS_DONE = 0
STATUS_OPEN = 1

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("Provider", T.StringType()),
        T.StructField("FileName", T.StringType()),
        T.StructField("CRC", T.StringType()),
        T.StructField("LastProcessedLine", T.LongType()),
        T.StructField("Status", T.IntegerType()),
        T.StructField("UpdatedAt", T.TimestampType()),
    ]
)
PROGRESS_KEY = ["Provider", "FileName"]

VERSIONS_SCHEMA = T.StructType(
    [
        T.StructField("Provider", T.StringType()),
        T.StructField("ETag", T.StringType()),
        T.StructField("UpdatedAt", T.TimestampType()),
    ]
)
VERSIONS_KEY = ["Provider"]


#: What a run could not read or load and is to be retried.
FAILURES_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("first_failed_at", T.TimestampType()),
        T.StructField("last_failed_at", T.TimestampType()),
    ]
)


def checked_status(col) -> "F.Column":
    """Status written to the progress table: 0 or 1, anything else fails."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(STATUS_DONE, STATUS_OPEN) | c.isNull(), c.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("invalid progress status "), c.cast("string"))).cast("int")
    )


# --- versions -------------------------------------------------------------

def version_changes(remote: DataFrame, stored: DataFrame) -> DataFrame:
    """``remote(provider, remote_version)`` ⟕ ``stored(Provider, ETag)``.

    A provider is *changed* when its stored version differs from the remote
    one and the remote one is not empty; an empty remote version means
    unchanged.  A provider never seen has stored version ``''``.
    """
    s = stored.select(F.col("Provider").alias("provider"), F.col("ETag").alias("stored_version"))
    return (
        remote.join(s, "provider", "left")
        .withColumn("stored_version", F.coalesce("stored_version", F.lit("")))
        .withColumn("remote_version", F.coalesce("remote_version", F.lit("")))
        .withColumn(
            "changed",
            (F.col("stored_version") != F.col("remote_version")) & (F.col("remote_version") != ""),
        )
    )


def incomplete_counts(progress: DataFrame) -> DataFrame:
    """Files per provider whose status is not 0 (NULL status not counted)."""
    return progress.groupBy(F.col("Provider").alias("provider")).agg(
        F.count_if(F.col("Status") != STATUS_DONE).alias("incomplete")
    )


def provider_gate(changes: DataFrame, incomplete: DataFrame) -> DataFrame:
    """``skip`` (unchanged, nothing open), ``resume`` (unchanged, files open)
    or ``import`` (changed)."""
    j = changes.join(incomplete, "provider", "left").withColumn(
        "incomplete", F.coalesce("incomplete", F.lit(0)).cast("long")
    )
    return j.withColumn(
        "action",
        F.when(F.col("changed"), F.lit("import"))
        .when(F.col("incomplete") > 0, F.lit("resume"))
        .otherwise(F.lit("skip")),
    )


def set_versions(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert ``new(Provider, ETag)`` into ``dataset_versions``."""
    n = new.select("Provider", "ETag").withColumn("UpdatedAt", F.current_timestamp())
    return upsert(stored.select(*VERSIONS_SCHEMA.names), n, VERSIONS_KEY)


# --- per-file resume state --------------------------------------------------

def resume_state(entries: DataFrame, progress: DataFrame) -> DataFrame:
    """Offset to resume each entry at, or skip.

    ``entries(provider, file, crc)`` ⟕ ``progress``: no progress row → 0;
    stored CRC differs → 0 (restart); same CRC and status 0 → skip; same CRC
    otherwise (status 1 or NULL) → stored ``LastProcessedLine`` or 0.
    Adds ``offset`` (NULL when skipped) and ``action`` (new, restart, skip,
    resume).
    """
    p = progress.select(
        F.col("Provider").alias("provider"),
        F.col("FileName").alias("file"),
        F.col("CRC").alias("stored_crc"),
        F.col("LastProcessedLine").alias("stored_line"),
        F.col("Status").alias("stored_status"),
    )
    j = entries.join(p, ["provider", "file"], "left")
    has_row = F.col("stored_crc").isNotNull() | F.col("stored_status").isNotNull() | F.col("stored_line").isNotNull()
    same_crc = F.coalesce(F.col("stored_crc"), F.lit("")) == F.col("crc")
    status = F.coalesce(F.col("stored_status"), F.lit(-1))
    action = (
        F.when(~has_row, "new")
        .when(~same_crc, "restart")
        .when(status == STATUS_DONE, "skip")
        .otherwise("resume")
    )
    offset = (
        F.when(action.isin("new", "restart"), F.lit(0))
        .when(action == "resume", F.coalesce(F.col("stored_line"), F.lit(0)))
        .cast("long")
    )
    return j.withColumn("action", action).withColumn("offset", offset).drop(
        "stored_crc", "stored_line", "stored_status"
    )


# --- progress lifecycle -----------------------------------------------------

def open_progress(progress: DataFrame, opened: DataFrame) -> DataFrame:
    """Insert-or-replace ``(Provider, FileName, CRC, LastProcessedLine)`` with
    status 1 and the current time."""
    n = opened.select(
        "Provider", "FileName", "CRC", F.col("LastProcessedLine").cast("long"),
        checked_status(F.lit(STATUS_OPEN)).alias("Status"),
        F.current_timestamp().alias("UpdatedAt"),
    )
    return upsert(progress.select(*PROGRESS_SCHEMA.names), n, PROGRESS_KEY)


def close_progress(progress: DataFrame, closed: DataFrame) -> DataFrame:
    """Update ``LastProcessedLine`` and ``Status`` of existing rows from
    ``closed(Provider, FileName, LastProcessedLine, Status)``; a close without
    a row creates nothing."""
    c = closed.select(
        "Provider", "FileName",
        F.col("LastProcessedLine").cast("long").alias("_line"),
        checked_status("Status").alias("_status"),
        F.lit(True).alias("_hit"),
    )
    j = progress.join(c, PROGRESS_KEY, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select(
        "Provider", "FileName", "CRC",
        F.when(hit, F.col("_line")).otherwise(F.col("LastProcessedLine")).alias("LastProcessedLine"),
        F.when(hit, F.col("_status")).otherwise(F.col("Status")).alias("Status"),
        F.when(hit, F.current_timestamp()).otherwise(F.col("UpdatedAt")).alias("UpdatedAt"),
    )


def rollback_points(batches: DataFrame, group_cols: list[str]) -> DataFrame:
    """Progress after a run in which some batches failed.

    ``batches``: one row per batch with ``last_line`` (line of its last row),
    ``size`` (rows in it) and ``failed``.  A file with a failed batch goes back
    to the start of its *earliest* failed batch (``last_line - size``, never
    below 0) with status 1; otherwise it ends at its last line with status 0.
    """
    start = saturating_sub(F.col("last_line"), F.col("size"))
    return batches.groupBy(*group_cols).agg(
        F.min(F.when(F.col("failed"), start)).alias("_rollback"),
        F.max("last_line").alias("_end"),
    ).select(
        *group_cols,
        F.coalesce("_rollback", "_end").cast("long").alias("LastProcessedLine"),
        F.when(F.col("_rollback").isNotNull(), F.lit(STATUS_OPEN))
        .otherwise(F.lit(STATUS_DONE))
        .cast("int")
        .alias("Status"),
    )


def record_failures(ledger: DataFrame, ran: DataFrame, failed: DataFrame) -> DataFrame:
    """The failure ledger after a run.  ``ran(provider)``: the providers it
    worked on; ``failed(provider, item, error)``: what failed in it.  Their
    items that failed again count one attempt more and keep the time of the
    first; their other items are settled and go; rows of other providers stay."""
    now = failed.groupBy("provider", "item").agg(F.max("error").alias("error"))
    before = ledger.select("provider", "item", "attempts", "first_failed_at")
    again = now.join(before, ["provider", "item"], "left").select(
        "provider", "item", "error", (F.coalesce("attempts", F.lit(0)) + 1).cast("long").alias("attempts"),
        F.coalesce("first_failed_at", F.current_timestamp()).alias("first_failed_at"),
        F.current_timestamp().alias("last_failed_at"))
    others = ledger.join(ran.select("provider").distinct(), "provider", "left_anti")
    return others.select(*FAILURES_SCHEMA.names).unionByName(again)


# --- metrics ----------------------------------------------------------------

def run_metrics(rows: DataFrame, provider_col: str = "provider", file_col: str = "file",
                line_col: str = "line_no", error_col: str = "error",
                count_col: str | None = None) -> DataFrame:
    """Per file: rows, last line, any error; per provider: total rows and any
    error (error of a file does not stop its siblings, but fails the
    provider).  ``count_col``: the rows an input row stands for (default 1)."""
    per_file = rows.groupBy(provider_col, file_col).agg(
        (F.count(F.lit(1)) if count_col is None else F.sum(count_col)).alias("rows"),
        F.max(line_col).alias("last_line"),
        F.bool_or(F.coalesce(F.col(error_col), F.lit(False))).alias("file_error"),
    )
    w = Window.partitionBy(provider_col)
    return per_file.withColumn("provider_rows", F.sum("rows").over(w)).withColumn(
        "provider_error", F.bool_or("file_error").over(w)
    )
