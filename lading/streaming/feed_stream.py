"""The periodic import as a Structured Streaming query over the landing
folder: ``readStream`` on the archives (``binaryFile``, content never read),
``trigger(availableNow=True)`` and ``foreachBatch``.

Each pass takes the archives that landed since the last pass (the stream's
checkpoint remembers which) and runs an import for their providers; then
providers that had no new archive but files left open by an earlier pass, or
rows in the failure ledger, are retried.  A pass over an unchanged landing
folder with nothing open does nothing.

A provider's failure is no failure of the pass: what cannot be read or loaded
is recorded in the progress table and the failure ledger, the micro-batch is
committed, and the pass raises :class:`PassFailed` at its end, after every
other provider was imported.  The failed ones are retried by each later pass,
without a new arrival, until they succeed (or a newer version replaces them).
What escapes a micro-batch is a fault of the cluster or the store; such a batch
is replayed, which is harmless: the import skips versions and files it already
recorded.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lading.operators.control import FAILURES_SCHEMA, PROGRESS_SCHEMA, STATUS_DONE
from lading.plans.ingest import FAILURES, MAX_ROWS_PER_RUN, PROGRESS, ImportFailed, ImportResult, import_landing
from lading.registry import DEFAULT, Registry
from lading.sinks.snapshots import read_table
from lading.sources.archive import ARCHIVE_SCHEMA


class PassFailed(RuntimeError):
    """Some providers failed in a pass; the others were imported and the
    stream's batches are committed.  ``results`` are the import results."""

    def __init__(self, failures: list[ImportFailed], results: list[ImportResult]):
        super().__init__("; ".join(map(str, failures)))
        self.results = results


def to_retry(spark: SparkSession, root: str) -> list[str]:
    """Providers with open files or rows in the failure ledger (one row each)."""
    opened = read_table(spark, root, PROGRESS, PROGRESS_SCHEMA).where(F.col("Status") != STATUS_DONE).select(F.col("Provider").alias("provider"))
    failed = read_table(spark, root, FAILURES, FAILURES_SCHEMA).select("provider")
    return sorted(r["provider"] for r in opened.union(failed).distinct().collect())


def import_stream(spark: SparkSession, landing: str, root: str, registry: Registry = DEFAULT,
                  max_rows: int | None = MAX_ROWS_PER_RUN, checkpoint: str | None = None,
                  keyless: str = "append") -> list[ImportResult]:
    """One availableNow pass over ``landing``; returns the import results."""
    results: list[ImportResult] = []
    failures: list[ImportFailed] = []

    def run(providers: list[str]) -> None:
        try:
            results.append(import_landing(spark, landing, root, registry, max_rows, providers=providers, keyless=keyless))
            if results[-1].failed():
                failures.append(ImportFailed(results[-1]))
        except ImportFailed as exc:  # recorded in the ledger: the batch is done
            results.append(exc.result)
            failures.append(exc)

    def run_batch(batch, epoch_id: int) -> None:
        providers = sorted(r["provider"] for r in batch.select("provider").distinct().collect())
        if providers:  # one row per provider with a new archive
            run(providers)

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(ARCHIVE_SCHEMA)
        .option("pathGlobFilter", "*.zip")
        .load(landing)
        .select("provider", "version", "path")
    )
    q = (
        arrivals.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint or f"{root.rstrip('/')}/_checkpoints/landing")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

    # What an earlier pass left open is retried without a new archive; the cap
    # holds once per provider and pass.
    ran = {r["provider"] for done in results for r in done.providers}
    waiting = [p for p in to_retry(spark, root) if p not in ran]
    if waiting:
        run(waiting)
    if failures:
        raise PassFailed(failures, results)
    return results
