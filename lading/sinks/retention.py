"""Retention: what a warehouse root holds and nothing names any more.

Data folders are named by the manifest, staged folders by the rows of
``control/staged_entries``, control folders by commits.  ``unreferenced`` lists
what none of the newest ``keep`` commits names; ``remove_unreferenced`` removes
it.  Staged records serve files that are still open, so rows of files that are
done (or open with another CRC) are settled first; folders of typed rows and
the records of runs that none of the rows left names go with them.  Rejects are
a report and go only when asked for, by age in runs of the run log.

Only folder names pass through the driver, no rows.  No import may run on the
root meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.operators import control
from lading.sinks.feed_tables import MANIFEST, MANIFEST_SCHEMA, _paths
from lading.sinks.snapshots import kept_commits, read_committed, read_table, vacuum, write_tables
from lading.sources.fs import list_dirs, remove_dir


def open_staged(staged: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows of staged entries whose file is still to be resumed with the same
    content.  Progress holds the entry's CRC with a hash of the declared columns."""
    todo = progress.where(F.col("Status") != control.STATUS_DONE).select(
        F.col("Provider").alias("provider"), F.col("FileName").alias("file"), F.split("CRC", ":")[0].alias("crc"))
    return staged.join(todo, ["provider", "file", "crc"], "left_semi")


def _data_folders(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Bucket folders of feed tables that no manifest of a kept commit names."""
    named: set[str] = set()
    for commit in kept_commits(root, keep):
        rows = read_committed(spark, root, MANIFEST, MANIFEST_SCHEMA, commit).collect()  # one row per bucket
        for t in {r["table"] for r in rows}:
            named.update(_paths(rows, root, t))
    base = f"{root.rstrip('/')}/tables"
    found = [f"{base}/{t}/{v}/{p}/{b}" for t in list_dirs(base) for v in list_dirs(f"{base}/{t}") if v.startswith("v=")
             for p in list_dirs(f"{base}/{t}/{v}") if p.startswith("_p=") for b in list_dirs(f"{base}/{t}/{v}/{p}") if b.startswith("_b=")]
    return sorted(set(found) - named)


def _old_rejects(spark: SparkSession, root: str, keep_runs: int) -> list[str]:
    """Reject folders of all but the newest ``keep_runs`` runs of the run log."""
    from lading.plans.ingest import RUN_LOG, RUN_LOG_SCHEMA

    log = read_table(spark, root, RUN_LOG, RUN_LOG_SCHEMA).groupBy("run").agg(F.max("ended_at").alias("at"))
    newest = {r["run"] for r in log.orderBy(F.desc("at"), "run").limit(keep_runs).collect()}
    base = f"{root.rstrip('/')}/rejects"
    return sorted(f"{base}/{d}" for d in list_dirs(base) if d.startswith("run=") and d[4:] not in newest)


def unreferenced(spark: SparkSession, root: str, keep: int = 2, keep_reject_runs: int | None = None) -> list[str]:
    """Folders that nothing names: feed-table buckets, staged and typed records,
    and, if ``keep_reject_runs`` is given, rejects of older runs."""
    from lading.plans.ingest import PROGRESS, STAGED, STAGED_SCHEMA

    staged = read_table(spark, root, STAGED, STAGED_SCHEMA)
    progress = read_table(spark, root, PROGRESS, control.PROGRESS_SCHEMA)
    in_use = {r["path"] for r in open_staged(staged, progress).select("path").distinct().collect()}  # one row per run
    base = f"{root.rstrip('/')}/staging"
    stale = sorted(f"{base}/{d}" for d in list_dirs(base) if d.startswith("run=") and f"{base}/{d}" not in in_use)
    rejects = [] if keep_reject_runs is None else _old_rejects(spark, root, keep_reject_runs)
    return _data_folders(spark, root, keep) + stale + rejects


def remove_unreferenced(spark: SparkSession, root: str, keep: int = 2, keep_reject_runs: int | None = None) -> list[str]:
    """Settle staged rows, then remove what :func:`unreferenced` lists and the
    control versions that no kept commit names.  The rows are committed before a
    folder goes, so a run killed in between leaves nothing named but missing."""
    from lading.plans.ingest import PROGRESS, STAGED, STAGED_SCHEMA, compact

    gone = unreferenced(spark, root, keep, keep_reject_runs)
    progress = read_table(spark, root, PROGRESS, control.PROGRESS_SCHEMA)
    staged = read_table(spark, root, STAGED, STAGED_SCHEMA)
    write_tables({STAGED: compact(open_staged(staged, progress))}, root)
    for path in gone:
        remove_dir(path)
    return gone + vacuum(root, keep)
