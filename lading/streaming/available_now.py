"""Periodic ingest as a Structured Streaming query with
``trigger(availableNow=True)``: every run takes the files that arrived since
the last one (the file source's checkpoint remembers what was taken), upserts
each micro-batch into a snapshot table and stops.  A second run over an
unchanged folder processes nothing.

Files may be taken in any order, so the row with the highest ordering value
wins, whether it is already in the table or arrives later.  The table is kept
in hash buckets of its key: a micro-batch rewrites only the buckets it falls
into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.operators.upsert import upsert_latest
from lading.sinks.feed_tables import MANIFEST_SCHEMA, apply_upserts, changed_manifest, read_feed_table
from lading.sinks.snapshots import read_table, write_table

_ALL = "all"  # the one provider of a table that knows none


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("provider", T.StringType()), *schema.fields])


def read_upserted(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """Current rows of a table kept by :func:`upsert_batches`."""
    rows = read_table(spark, root, f"{name}/manifest", MANIFEST_SCHEMA).collect()  # one row per bucket
    return read_feed_table(spark, root, name, _stored(schema), manifest_rows=rows, base="").select(*schema.names)


def upsert_batches(root: str, name: str, schema: T.StructType, key: list[str],
                   order_cols: list[str]):
    """``foreachBatch`` function: apply a micro-batch to the table
    ``<root>/<name>`` and commit it."""

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = read_table(spark, root, f"{name}/manifest", MANIFEST_SCHEMA).collect()
        new = batch.select(F.lit(_ALL).alias("provider"), *schema.names)
        # The first batch decides the number of buckets; later the manifest knows the table's size.
        count = 0 if rows else batch.count()
        if rows or count:
            updates = apply_upserts(spark, root, name, _stored(schema), new, {_ALL: count}, key, order_cols, rows,
                                    merge=upsert_latest, base="")
            _, manifest = changed_manifest(spark, rows, name, [_ALL], updates)
            write_table(manifest.hint("rebalance"), root, f"{name}/manifest")

    return apply


def upsert_stream(spark: SparkSession, landing: str, schema: T.StructType, root: str,
                  name: str, key: list[str], order_cols: list[str],
                  max_files_per_trigger: int | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """Run one availableNow pass over the Parquet files below ``landing`` and
    return the resulting table."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.parquet(landing)
    q = (
        src.writeStream.foreachBatch(upsert_batches(root, name, schema, key, order_cols))
        .option("checkpointLocation", checkpoint or f"{root.rstrip('/')}/_checkpoints/{name}")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_upserted(spark, root, name, schema)
