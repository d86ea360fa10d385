"""One import run over a landing folder.

::

  landing/provider=P/version=V/*.zip
    binaryFile ─ newest version per provider ─ gate (version, open files)
    └ list entries ─ entry filter ─ ⋈ registry ─ ⟕ progress ─► plan (one row per file)
  progress: every planned file opened (status 1)
  plan ─ expand (entries dealt to tasks by size) ─► staged records (Parquet)
         └ per entry: header, last record or error
  staged ⋈ plan ─ from_csv ─ drop malformed ─ offset ─ budget ─ project ─ type ─┬► upsert (touched buckets)
                                                                             └► rejects
  per table: manifest + closed progress rows in one commit
  last: dataset_versions + run log

Everything that is per row or per file runs in executors: the file plan, the
outcome of each entry, header positions, grants and counts are tables of the
run (one row per file, written to the shared folder), joined where needed.  The
driver sees providers, tables, buckets and the few entries large enough to be
dealt to tasks one by one.

A file whose entry cannot be read stays open at its old offset while its
siblings load; so do the files of a table that failed.  While an archive of a
version cannot be read, the version is not recorded and open files that may be
in it stay open.  Every failed file and unread archive is kept in the failure
ledger (``control/failures``), with its error and how often it was tried, until
a run gets past it.  The run then ends with :class:`ImportFailed` (if all it met
were versions without a readable archive and there is nothing to import, it
returns with ``file_errors`` set).  Killing a
run leaves the last committed state; the next run redoes what was not
committed, and nothing is loaded twice because a table's data and its progress
become current together.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.functions.names import entry_table_name, is_feed_entry
from lading.operators import control
from lading.operators.lines import batch_number, file_quotas
from lading.operators.parse import (
    build_plan,
    declared_columns,
    field_count,
    parse_lines,
    registered_entries,
    type_columns,
)
from lading.operators.upsert import upsert
from lading.registry import CONTROL_TABLES, DEFAULT, LogicalTable, Registry, registry_df
from lading.sinks.feed_tables import (
    MANIFEST,
    apply_upserts,
    changed_manifest,
    read_feed_table,
    read_manifest,
)
from lading.sinks.snapshots import Parted, read_table, write_table, write_tables
from lading.session import scratch_path
from lading.sources.archive import END_LINE, ERROR_LINE, LINE_SCHEMA, expand_entries, list_entries, read_archives

MAX_ROWS_PER_RUN = 100_000
# Lines per block when a capped file's valid rows are counted.
COUNT_BLOCK = 4096
# Lines whose outcome is common: a batch loads or fails as a whole.
BATCH_ROWS = 500
# Failed files named in an error message; all of them are in the ledger.
SHOWN_ERRORS = 20
# Tables loaded at the same time.
TABLE_THREADS = 4
_INFO_SCHEMA = "provider string, file string, crc string, table string, width int, n_matched int, offset long, last long"
_OUTCOME = "provider string, file string, table string, last_line long, status int, rows long, error string, table_error string"
PROGRESS = "control/import_progress"
VERSIONS = "control/dataset_versions"
RUN_LOG = "control/run_log"
FAILURES = "control/failures"
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("last_line", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("ended_at", T.TimestampType()),
    ]
)
STAGED = "control/staged_entries"
STAGED_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("crc", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)


@dataclass
class ImportResult:
    spark: SparkSession
    root: str
    registry: Registry
    outcomes: DataFrame | None = None  # one row per file of the run and unread archive (``_OUTCOME``)
    providers: list = field(default_factory=list)  # per-provider gate rows
    timings: dict = field(default_factory=dict)  # seconds per phase
    errors: dict = field(default_factory=dict)  # table -> error of this run
    reused: int = 0  # files read from an earlier run's staged records

    def table(self, name: str) -> DataFrame:
        lt = self.registry.tables[name]
        return read_feed_table(self.spark, self.root, name, lt.spark_schema())

    def progress(self) -> DataFrame:
        return read_table(self.spark, self.root, PROGRESS, control.PROGRESS_SCHEMA)

    def versions(self) -> DataFrame:
        return read_table(self.spark, self.root, VERSIONS, control.VERSIONS_SCHEMA)

    def failures(self) -> DataFrame:
        """The failure ledger: what is still to be retried."""
        return read_table(self.spark, self.root, FAILURES, control.FAILURES_SCHEMA)

    def file_table(self) -> DataFrame:
        return self.outcomes if self.outcomes is not None else self.spark.createDataFrame([], _OUTCOME)

    @cached_property
    def files(self) -> list[dict]:
        """The outcome of every file, for callers that want them as a list."""
        return [r.asDict() for r in self.file_table().drop("error", "table_error").collect()]

    @cached_property
    def file_errors(self) -> dict:
        """(provider, file) -> error, of files and archives that failed themselves."""
        return {(r["provider"], r["file"]): r["error"] for r in self.file_table().where(F.col("error").isNotNull()).collect()}

    def rows_imported(self) -> int:
        return self.file_table().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def failed(self) -> bool:
        bad = F.col("error").isNotNull() | F.col("table_error").isNotNull()
        return bool(self.errors) or not self.file_table().where(bad).isEmpty()

    def run_log(self) -> DataFrame:
        """Rows and last line per file, totals per provider, and whether a
        file or its table failed — the run log as a table (one row per file)."""
        rows = self.file_table().select(
            "provider", "file", F.col("rows").alias("n"), F.col("last_line").alias("line_no"),
            F.coalesce("error", "table_error").isNotNull().alias("error"))
        return control.run_metrics(rows, count_col="n")


def _kept(df: DataFrame, path: str) -> DataFrame:
    """A table of the run, written once and read again."""
    compact(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _newest_versions(archives: DataFrame) -> DataFrame:
    """Per provider, the version folder holding the newest archive."""
    return archives.groupBy("provider").agg(
        F.max_by("version", F.struct("modificationTime", "version")).alias("remote_version")
    )


def import_landing(spark: SparkSession, landing: str, root: str,
                   registry: Registry = DEFAULT, max_rows: int | None = MAX_ROWS_PER_RUN,
                   providers: list[str] | None = None, keyless: str = "append",
                   refuse: Callable[[LogicalTable], Column | None] | None = None, batch_rows: int = BATCH_ROWS) -> ImportResult:
    """Import the newest feed version of every provider below ``landing``
    into the tables under ``root``.  ``max_rows`` caps the valid rows per
    provider and run (``None``: no cap); the next run continues where this
    one stopped.  ``providers``: restrict to these (e.g. the active ones of
    the catalogue).  ``keyless``: ``append`` (a re-imported file of a keyless
    table adds its rows again) or ``replace_file`` (its earlier rows are
    replaced).  ``refuse`` gives, per table, a condition on its typed columns
    for rows the store does not take: a batch of ``batch_rows`` lines with such a
    row fails as a whole, the file's lines before its earliest failed batch are
    loaded, and the file stays open there."""
    if keyless not in ("append", "replace_file"):
        raise ValueError(f"keyless must be 'append' or 'replace_file', not {keyless!r}")
    result = ImportResult(spark, root, registry)
    run_id = uuid.uuid4().hex[:12]
    clock = [time.perf_counter()]

    def _mark(phase: str) -> None:
        now = time.perf_counter()
        result.timings[phase] = round(now - clock[0], 3)
        clock[0] = now

    archives_all = read_archives(spark, landing)
    if providers is not None:
        archives_all = archives_all.where(F.col("provider").isin(providers))
    meta = archives_all.select("provider", "version", "path", "modificationTime")
    remote = _newest_versions(meta)

    versions = read_table(spark, root, VERSIONS, control.VERSIONS_SCHEMA)
    progress = read_table(spark, root, PROGRESS, control.PROGRESS_SCHEMA)
    changes = control.version_changes(remote, versions)
    gate = control.provider_gate(changes, control.incomplete_counts(progress))
    todo = gate.where(F.col("action") != "skip").select("provider", "remote_version", "action")
    gate_rows = gate.collect()  # one row per provider
    _mark("gate")
    result.providers = [r.asDict() for r in gate_rows]
    if not any(r["action"] != "skip" for r in gate_rows):
        return result

    own = scratch_path(spark, f"import-{run_id}")  # tables of this run
    # Progress is kept in parts by provider: only those of this run's providers
    # are read from here on, and written.
    running = sorted(r["provider"] for r in gate_rows if r["action"] != "skip")
    progress = read_table(spark, root, PROGRESS, control.PROGRESS_SCHEMA, running)
    current = archives_all.join(todo.withColumnRenamed("remote_version", "version"), ["provider", "version"])
    declared = declared_columns(registry_df(spark, registry))
    # The listing reads only central directories; it is kept for the plan
    # and for telling readable archives from broken ones.
    listed = _kept(list_entries(current), f"{own}/listing")
    unread = listed.where(F.col("error").isNotNull())
    listing = listed.where(F.col("error").isNull())
    found = listed.groupBy("provider").agg(F.count_if(F.col("error").isNull()).alias("files"), F.count("error").alias("unread")).collect()  # one row per provider
    with_files = {r["provider"] for r in found if r["files"]}
    unread_providers = {r["provider"] for r in found if r["unread"]}
    readable = with_files - unread_providers
    entries = registered_entries(
        listing
        .where(is_feed_entry("file"))
        .withColumn("table", entry_table_name("file"))
        .where(~F.col("table").isin(*CONTROL_TABLES)),
        declared, ["provider", "table"])
    # The stored fingerprint is the entry's CRC plus a hash of the columns
    # declared for its table: a file whose content is unchanged is still
    # imported again when its declared schema changed.
    entries = entries.withColumn("raw_crc", F.col("crc")).withColumn(
        "crc",
        F.concat("raw_crc", F.lit(":"), F.substring(F.md5(F.concat_ws(",", "declared")), 1, 8)),
    )
    # One row per file to import.  A file name in two archives of a version is
    # an error of that file.
    place = ("archive", "version", "size", "crc", "raw_crc", "table", "offset")
    plan = _kept(
        control.resume_state(entries, progress).where(F.col("action") != "skip")
        .groupBy("provider", "file").agg(F.min(F.struct(*place)).alias("p"), F.count(F.lit(1)).alias("n"), F.max("archive").alias("other"))
        .select("provider", "file", "p.*", F.when(F.col("n") > 1, F.concat(
            F.lit("in two archives of version "), "p.version", F.lit(": "), "p.archive", F.lit(", "), "other",
            F.lit("; one file name per provider version"))).alias("error")), f"{own}/plan")
    # Open files that the provider's current archives no longer have cannot be
    # resumed: they are closed where they stand, unless an archive is unread.
    unlisted = (
        progress.where(F.col("Status") != control.STATUS_DONE)
        .join(todo.select(F.col("provider").alias("Provider")), "Provider", "left_semi")
        .join(listing.select(F.col("provider").alias("Provider"), F.col("file").alias("FileName")), control.PROGRESS_KEY, "left_anti")
    )
    vanished = unlisted.where(F.col("Provider").isin(sorted(readable))).select(
        "Provider", "FileName", "LastProcessedLine", F.lit(control.STATUS_DONE).alias("Status"))
    none = spark.createDataFrame([], _OUTCOME)
    lost, blocked = none, False
    if unread_providers:
        broken = unread.select("provider", F.col("archive").alias("file"), F.lit(0).alias("last_line"),
                               F.concat(F.lit("the archive cannot be read: "), "error").alias("error"))
        waiting = unlisted.where(F.col("Provider").isin(sorted(unread_providers))).select(
            F.col("Provider").alias("provider"), F.col("FileName").alias("file"), F.col("LastProcessedLine").alias("last_line"),
            F.lit("not listed, and an archive of its provider cannot be read").alias("error"))
        lost = _kept(_outcome(broken.unionByName(waiting), F.lit(None), F.lit(control.STATUS_OPEN)), f"{own}/lost")
        blocked = bool(with_files & unread_providers) or not waiting.isEmpty()
    n_plan = plan.count()
    _mark("plan")
    # A new version is recorded once all its archives could be read, even when
    # no file in them changed; with an unreadable one it is retried next run.
    changed = todo.where(
        (F.col("action") == "import") & F.col("provider").isin(sorted(readable))
    ).select(F.col("provider").alias("Provider"), F.col("remote_version").alias("ETag"))
    ran = todo.select("provider")
    ledger = read_table(spark, root, FAILURES, control.FAILURES_SCHEMA)
    # Progress is open (status 1) before any record is read.
    progress = control.open_progress(control.close_progress(progress.select(*control.PROGRESS_SCHEMA.names), vanished), plan.select(
        F.col("provider").alias("Provider"), F.col("file").alias("FileName"),
        F.col("crc").alias("CRC"), F.col("offset").alias("LastProcessedLine")))
    if not n_plan:
        write_tables({PROGRESS: _progress_of(progress, running), VERSIONS: compact(control.set_versions(versions, changed)),
                      FAILURES: compact(_ledger(ledger, ran, lost))}, root)
        result.outcomes = lost
        if blocked:
            raise ImportFailed(result)
        return result
    write_tables({PROGRESS: _progress_of(progress, running)}, root)
    _mark("open")

    # Staged records: entries staged by an earlier run with the same CRC
    # (a resumed file) are read again, not decompressed again; the others are
    # expanded once, in parallel, and recorded as staged if read to their end.
    good = plan.where(F.col("error").isNull()).drop("error")
    staged_ctl = read_table(spark, root, STAGED, STAGED_SCHEMA)
    reuse = _kept(staged_ctl.join(
        good.select("provider", "file", F.col("raw_crc").alias("crc"), "table"),
        ["provider", "file", "crc", "table"], "left_semi").select("provider", "file", "path"), f"{own}/reuse")
    old_paths = {r["path"]: r["n"] for r in reuse.groupBy("path").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per earlier run
    result.reused = sum(old_paths.values())
    to_expand = good.join(reuse, ["provider", "file"], "left_anti")
    n_good, least = good.agg(F.count(F.lit(1)), F.min("offset")).first()
    stage_path = f"{root.rstrip('/')}/staging/run={run_id}"
    if n_good > result.reused:
        # No partitionBy: it would sort the records by table, and a sort that
        # spills does not keep their file order.  Each entry lands in one
        # file, in order; the table column's statistics prune files per table.
        expand_entries(to_expand.select("provider", "version", "archive", "file", "size", F.col("raw_crc").alias("crc"), "table"),
                       carry=("crc", "table")).drop("version").write.parquet(stage_path)
        old_paths[stage_path] = 0
    records = staged_scan(spark, sorted(old_paths), least or 0) if old_paths else spark.createDataFrame([], STAGED_RECORD)
    # One scan for the outcome of every file: header, last record, error.
    line_no = F.col("line_no")
    ended = records.where(line_no <= 0).groupBy("provider", "file", "crc").agg(
        F.max(F.when(line_no == 0, F.col("header"))).alias("header"),
        F.max(F.when(line_no == END_LINE, F.col("line").cast("long"))).alias("last"),
        F.max(F.when(line_no == ERROR_LINE, F.col("error"))).alias("read_error")).withColumnRenamed("crc", "raw_crc")
    opened = _kept(
        plan.join(ended, ["provider", "file", "raw_crc"], "left")
        .withColumn("error", F.coalesce("error", "read_error", F.when(F.col("last").isNull(), F.lit("its staged records have no end"))))
        .drop("read_error", "version", "archive", "size"), f"{own}/opened")
    usable = opened.where(F.col("error").isNull())
    if stage_path in old_paths:
        new_ctl = usable.join(reuse, ["provider", "file"], "left_anti").select(
            "provider", "file", F.col("raw_crc").alias("crc"), "table", F.lit(stage_path).alias("path"))
        write_table(compact(upsert(staged_ctl, new_ctl, ["provider", "file", "crc"], new_is_unique=True)), root, STAGED)
    _mark("expand")

    # Per table, the file plan: header positions per file.
    tables = sorted(r["table"] for r in usable.select("table").distinct().collect())  # one row per table
    ends = usable.select("provider", "file", F.col("raw_crc").alias("crc"), "offset", F.greatest("last", "offset").alias("last"))
    file_plans = {t: build_plan(usable.where(F.col("header").isNotNull()).select("provider", "file", "table", "header"), declared, registry.tables[t])
                  .join(ends, ["provider", "file"]) for t in tables}
    columns = ["provider", "file", "crc", "table", "width", "n_matched", "offset", "last"]
    info = [p.where(F.col("n_matched") > 0).select(*columns) for p in file_plans.values()]
    info = _kept(reduce(DataFrame.unionByName, info) if info else spark.createDataFrame([], _INFO_SCHEMA), f"{own}/info")
    by_table = info.groupBy("table").agg(F.max("width").alias("width"), F.collect_set("provider").alias("providers")).collect()  # one row per table
    widths, table_providers = {r["table"]: r["width"] for r in by_table}, {r["table"]: r["providers"] for r in by_table}
    _mark("headers")

    grants = _kept(_grants(records, info, max_rows, f"{own}/blocks"), f"{own}/grants")
    _mark("budget")

    # Parse, project, type and upsert, one pass per logical table, several at
    # a time; each table's data and progress become current in one commit.
    manifest_rows = read_manifest(spark, root).collect()  # one row per bucket
    failed: dict[str, str] = {}
    counted: list[DataFrame] = []
    refused: list[DataFrame] = []
    # Files without a matching column, and files without even a header
    # line, are completed no-ops.
    noop = usable.join(info, ["provider", "file"], "left_anti").select("provider", "file", "table", F.col("offset").alias("last_line"))

    def closes(granted: DataFrame, broken: DataFrame | None) -> DataFrame:
        """Where a table's files end: their last granted line, or the start of
        their earliest failed batch."""
        batches = granted.select("provider", "file", F.col("upto").alias("last_line"), (F.col("upto") - F.col("offset")).alias("size"), F.lit(False).alias("failed"))
        ends = control.rollback_points((batches if broken is None else batches.unionByName(broken)).withColumnsRenamed(
            {"provider": "Provider", "file": "FileName"}), control.PROGRESS_KEY)
        capped = granted.where(F.col("status") == control.STATUS_OPEN).select(
            F.col("provider").alias("Provider"), F.col("file").alias("FileName"), F.lit(control.STATUS_OPEN).alias("_open"))
        return ends.join(capped, control.PROGRESS_KEY, "left").withColumn(
            "Status", F.coalesce("_open", "Status")).drop("_open")

    with ThreadPoolExecutor(TABLE_THREADS) as pool:
        jobs = {
            pool.submit(_load_table, spark, root, registry, t, records, stage_path, run_id, file_plans[t],
                        grants.where(F.col("table") == t), widths[t], manifest_rows, result.timings, own, keyless,
                        refuse(registry.tables[t]) if refuse else None, batch_rows): t
            for t in sorted(widths)
        }
        for job in as_completed(jobs):
            t = jobs[job]
            try:
                providers_of, updates, counts, broken = job.result()
                manifest_rows, manifest = changed_manifest(spark, manifest_rows, t, providers_of, updates)
                progress = read_table(spark, root, PROGRESS, control.PROGRESS_SCHEMA, table_providers[t])
                closed = control.close_progress(progress, closes(grants.where(F.col("table") == t), broken))
                write_tables({MANIFEST: compact(manifest), PROGRESS: _progress_of(closed, table_providers[t])}, root)
                counted.append(counts)
                refused += [broken] if broken is not None else []
            except Exception as exc:  # noqa: BLE001 - one table's failure must not stop the others
                failed[t] = f"{type(exc).__name__}: {exc}"
            _mark(f"table:{t}")

    result.errors = failed
    loaded = reduce(DataFrame.unionByName, counted) if counted else spark.createDataFrame([], "provider string, file string, rows long")
    bad = spark.createDataFrame(sorted(failed.items()), "table string, table_error string")
    cuts = spark.createDataFrame([], "provider string, file string, cut long")
    if refused:
        cuts = control.rollback_points(reduce(DataFrame.unionByName, refused), ["provider", "file"]).select("provider", "file", F.col("LastProcessedLine").alias("cut"))
    undone, cut = F.col("table_error").isNotNull(), F.col("cut")
    granted = grants.join(loaded, ["provider", "file"], "left").join(cuts, ["provider", "file"], "left").join(bad, "table", "left").select(
        "provider", "file", "table", F.when(undone, F.col("offset")).otherwise(F.coalesce(cut, "upto")).alias("last_line"),
        F.when(undone | cut.isNotNull(), F.lit(control.STATUS_OPEN)).otherwise(F.col("status")).alias("status"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.when(cut.isNotNull() & ~undone, F.concat(F.lit("the batch after line "), cut.cast("string"), F.lit(" was refused"))).alias("error"), "table_error")
    unusable = opened.where(F.col("error").isNotNull()).select("provider", "file", "table", F.col("offset").alias("last_line"), "error")
    result.outcomes = _kept(
        granted.unionByName(_outcome(noop.withColumn("error", F.lit(None)), F.col("table"), F.lit(control.STATUS_DONE)))
        .unionByName(_outcome(unusable, F.col("table"), F.lit(control.STATUS_OPEN))).unionByName(lost), f"{own}/outcomes")
    # Versions last: a crash before this line makes the next run redo the
    # import instead of skipping it.
    done = noop.select(F.col("provider").alias("Provider"), F.col("file").alias("FileName"),
                       F.col("last_line").alias("LastProcessedLine"), F.lit(control.STATUS_DONE).alias("Status"))
    log = result.outcomes.select(F.lit(run_id).alias("run"), "provider", "file", "rows", "last_line",
                                 F.coalesce("error", "table_error").alias("error"), F.current_timestamp().alias("ended_at"))
    idle = [r["Provider"] for r in done.select("Provider").distinct().collect()]  # one row per provider
    write_tables({
        PROGRESS: _progress_of(control.close_progress(read_table(spark, root, PROGRESS, control.PROGRESS_SCHEMA, idle), done), idle),
        VERSIONS: compact(control.set_versions(versions, changed)),
        FAILURES: compact(_ledger(ledger, ran, result.outcomes)),
        RUN_LOG: compact(read_table(spark, root, RUN_LOG, RUN_LOG_SCHEMA).unionByName(log)),
    }, root)
    _mark("control")
    if result.failed():
        raise ImportFailed(result)
    return result


def _outcome(df: DataFrame, table: Column, status: Column) -> DataFrame:
    """Rows of ``_OUTCOME`` that loaded nothing: (provider, file, last_line, error)."""
    return df.select(
        "provider", "file", table.cast("string").alias("table"), F.col("last_line").cast("long").alias("last_line"),
        status.cast("int").alias("status"), F.lit(0).cast("long").alias("rows"), F.col("error").cast("string").alias("error"),
        F.lit(None).cast("string").alias("table_error"))


def _ledger(ledger: DataFrame, ran: DataFrame, outcomes: DataFrame) -> DataFrame:
    what = F.coalesce("error", "table_error")
    return control.record_failures(ledger, ran, outcomes.where(what.isNotNull()).select("provider", F.col("file").alias("item"), what.alias("error")))


def _progress_of(progress: DataFrame, providers: list[str]) -> Parted:
    """Progress to be written: the parts of these providers."""
    return Parted(progress, "Provider", providers)


def compact(df: DataFrame) -> DataFrame:
    """A control table in as few files as its size asks for."""
    return df.hint("rebalance")


def _grants(records: DataFrame, info: DataFrame, max_rows: int | None, blocks_path: str) -> DataFrame:
    """How far each file may go: provider, file, table, offset, upto, status.
    An upper bound comes from the record numbers alone; only providers whose
    bound exceeds the budget have their valid rows counted, in blocks of lines.
    Quotas and cut lines are joins from end to end."""
    files = info.withColumn("bound", F.col("last") - F.col("offset"))
    out = ["provider", "file", "table", "offset"]
    whole = files.select(*out, F.col("last").alias("upto"), F.lit(control.STATUS_DONE).alias("status"))
    if max_rows is None:
        return whole
    over = files.groupBy("provider").agg(F.sum("bound").alias("b")).where(F.col("b") > max_rows).select("provider")
    if over.isEmpty():
        return whole
    key = ["provider", "file"]
    exact = files.join(over, "provider", "left_semi")
    fields = F.coalesce("n_fields", field_count("line"))
    counted = records.join(exact.select(*key, "crc", "offset", "width"), [*key, "crc"]).where(
        (F.col("line_no") > F.col("offset")) & ~F.col("bad_utf8") & (fields == F.col("width"))
    ).select(*key, "line_no", F.floor(F.col("line_no") / COUNT_BLOCK).alias("block"))
    blocks = _kept(counted.groupBy(*key, "block").agg(F.count(F.lit(1)).alias("n")), blocks_path)
    valid = blocks.groupBy(*key).agg(F.sum("n").alias("rows"))
    quotas = file_quotas(exact.join(valid, key, "left").select(*out, "last", F.coalesce("rows", F.lit(0)).alias("rows")), max_rows)
    # At most one file a provider is cut inside: the line of its last granted row.
    partial = quotas.where(~F.col("file_done") & (F.col("quota") > 0)).select(*key, "quota")
    before = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = (blocks.join(partial, key)
          .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
          .where((F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
          .select(*key, "block", (F.col("quota") - F.col("before")).alias("nth")))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("line_no"))
    cut = counted.join(at, [*key, "block"]).withColumn("k", nth).where(F.col("k") == F.col("nth")).select(*key, F.col("line_no").alias("cut"))
    capped = quotas.join(cut, key, "left").select(
        *out, F.when(F.col("file_done"), F.col("last")).otherwise(F.coalesce("cut", "offset")).alias("upto"),
        F.when(F.col("file_done"), F.lit(control.STATUS_DONE)).otherwise(F.lit(control.STATUS_OPEN)).alias("status"))
    return whole.join(over, "provider", "left_anti").unionByName(capped)


STAGED_RECORD = T.StructType([
    *[f for f in LINE_SCHEMA.fields if f.name != "version"],
    T.StructField("crc", T.StringType()), T.StructField("table", T.StringType())])


def staged_scan(spark: SparkSession, paths: list[str], least: int) -> DataFrame:
    """The staged records of some runs' folders.

    Records at or before the least offset of the run are not read: records are
    stored in file order, so Parquet skips them by row-group statistics.  Each
    file's own offset is applied where its rows are taken.
    """
    staged = spark.read.schema(STAGED_RECORD).parquet(*paths)
    return staged.where((F.col("line_no") <= 0) | (F.col("line_no") > least)) if least > 0 else staged


def staged_records(spark: SparkSession, paths: list[str], plan_df: DataFrame, plan_rows) -> DataFrame:
    """The staged records of the planned files (``plan_rows``: their offsets)."""
    staged = staged_scan(spark, paths, min((int(r["offset"]) for r in plan_rows), default=0))
    return staged.join(
        plan_df.select("provider", "file", F.col("raw_crc").alias("crc")), ["provider", "file", "crc"], "left_semi")


def _load_table(spark, root, registry, t, records, stage_path, run_id, file_plan, grants, width, manifest_rows,
                timings, own: str, keyless: str = "append", refuse: Column | None = None,
                batch_rows: int = BATCH_ROWS) -> tuple[list[str], list[dict], DataFrame, DataFrame | None]:
    """Parse, type and upsert the granted rows of one logical table; returns
    the providers changed, their manifest rows, the rows loaded per file and the
    batches that failed (None without any)."""
    clock = [time.perf_counter()]

    def step(name: str) -> None:
        now = time.perf_counter()
        timings[f"{t}:{name}"] = round(now - clock[0], 3)
        clock[0] = now

    lt = registry.tables[t]
    fp = file_plan.join(grants.select("provider", "file", "upto"), ["provider", "file"])
    # One join selects the records and brings their header positions.
    taken = parse_lines(records.where(F.col("table") == t), fp, lt, width, bounded=True).where("valid")
    # Typed rows are written once to the staging folder; the upsert's lineage
    # starts there.
    typed_path = f"{stage_path}_typed/table={t}"
    typed = type_columns(taken, lt)
    typed.withColumn("_refused", F.lit(False) if refuse is None else F.coalesce(refuse, F.lit(False))).write.parquet(typed_path)
    typed = spark.read.parquet(typed_path)
    step("parse_type_write")
    typed, broken = _whole_batches(typed, fp, f"{own}/refused_{t}", batch_rows) if refuse is not None else (typed, None)
    counts = _kept(typed.groupBy("provider", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_rejects") > 0).alias("rejected")), f"{own}/counts_{t}")
    per_provider = counts.groupBy("provider").agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")).collect()  # one row per provider
    if any(r["rejected"] for r in per_provider):
        typed.where(F.size("_rejects") > 0).select(
            "provider", F.lit(t).alias("table"), "file", "line_no", F.explode("_rejects").alias("r"),
        ).select("provider", "table", "file", "line_no", "r.column", "r.text").write.parquet(
            f"{root.rstrip('/')}/rejects/run={run_id}/part={t}")
    counts = counts.drop("rejected")
    step("counts_rejects")
    new_rows = {r["provider"]: r["rows"] for r in per_provider}
    if not new_rows:
        return [], [], counts, broken
    new = typed.withColumn("_source_file", F.col("file")).select(*lt.spark_schema().names, "file", "line_no")
    loose = [p for p in registry.keyless_providers(t) if p in new_rows] if lt.key else sorted(new_rows)
    replace = None
    if keyless == "replace_file" and loose:
        replace = counts.where(F.col("provider").isin(loose)).select("provider", F.col("file").alias("_source_file"))
    updates = apply_upserts(spark, root, t, lt.spark_schema(), new, new_rows, list(lt.key),
                            ["file", "line_no"], manifest_rows, keyless=loose, replace_files=replace)
    step("upsert_write")
    return sorted(new_rows), updates, counts, broken


def _whole_batches(typed: DataFrame, plan: DataFrame, path: str, batch_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows before each file's earliest failed batch, and the failed
    batches: provider, file, last_line, size, failed."""
    if typed.where("_refused").isEmpty():
        return typed, None
    begin, key = F.col("_b") * batch_rows, ["provider", "file"]
    failed = typed.where("_refused").select(*key, batch_number("line_no", batch_rows).alias("_b")).distinct().join(plan.select(*key, "offset", "upto"), key)
    last = F.least(begin + batch_rows, F.col("upto"))
    failed = _kept(failed.select(*key, last.alias("last_line"), (last - F.greatest(begin, F.col("offset"))).alias("size"), F.lit(True).alias("failed")), path)
    cuts = control.rollback_points(failed, key).select(*key, F.col("LastProcessedLine").alias("_cut"))
    kept = typed.join(cuts, key, "left").where(F.col("_cut").isNull() | (F.col("line_no") <= F.col("_cut"))).drop("_cut")
    return kept, failed


class ImportFailed(RuntimeError):
    """Some files or tables failed; the others were committed.
    ``result.errors`` maps table → error, ``result.file_errors`` (provider,
    file) → error; the files concerned stay open at their old offset."""

    def __init__(self, result: "ImportResult"):
        what = [f"{t}: {e}" for t, e in sorted(result.errors.items())]
        own = result.file_table().where(F.col("error").isNotNull()).orderBy("provider", "file")
        what += [f"{r['provider']}/{r['file']}: {r['error']}" for r in own.limit(SHOWN_ERRORS).collect()]
        super().__init__("import failed for " + "; ".join(what))
        self.result = result


def import_catalogue(spark: SparkSession, catalogue_path: str, landing: str, root: str,
                     registry: Registry = DEFAULT, max_rows: int | None = MAX_ROWS_PER_RUN) -> ImportResult:
    """Import run for the active providers of a catalogue file."""
    from lading.sources.catalogue import active_providers, read_catalogue

    active = [r["provider"] for r in active_providers(read_catalogue(spark, catalogue_path)).collect()]
    return import_landing(spark, landing, root, registry, max_rows, providers=active)
