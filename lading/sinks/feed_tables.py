"""Feed tables: one logical table holds every provider's rows.

Rows with a complete key live in hash buckets per provider; a run rewrites
only the buckets that its new rows fall into.  Rows that never conflict (NULL
in the key, or a provider that declares the table without a key) are only
added: each run writes them to a part of its own (bucket ``LOOSE``).

``<root>/tables/<table>/v=<n>/_p=<provider hash>/_b=<bucket>/*.parquet`` —
a run writes one new version folder per table, holding only what it changed.
The manifest names, per table, provider and bucket, the version that holds it
(several for ``LOOSE``).  It is committed together with the progress rows, so
readers see the state before the run or after it.

A touched bucket whose incoming rows all equal the stored ones keeps its files:
a release that repeats last week's rows rewrites only buckets with a difference.

The number of buckets follows the provider's rows (``BUCKET_ROWS`` each, a
power of two); when a provider has outgrown it fourfold, the run that finds
out rewrites the provider once with more.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.operators.upsert import complete_key, last_wins, upsert
from lading.sinks.snapshots import next_version, read_table

MANIFEST = "control/manifest"
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("rows", T.LongType()),
    ]
)
LOOSE = -1
BUCKET_ROWS = 1_000_000


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, MANIFEST, MANIFEST_SCHEMA)


def _folder(provider: str) -> str:
    """Folder name of a provider: safe whatever the provider is called."""
    return hashlib.md5(provider.encode("utf-8")).hexdigest()[:16]


def _paths(rows, root: str, table: str, base: str = "tables") -> list[str]:
    return sorted({
        f"{_home(root, base)}/{table}/v={r['version']:08d}/_p={_folder(r['provider'])}/_b={r['bucket']}"
        for r in rows if r["table"] == table
    })


def _home(root: str, base: str) -> str:
    return f"{root.rstrip('/')}/{base}".rstrip("/")


def _read(spark: SparkSession, root: str, table: str, schema: T.StructType, rows, base: str = "tables") -> DataFrame:
    paths = _paths(rows, root, table, base)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_feed_table(spark: SparkSession, root: str, table: str, schema: T.StructType,
                    providers: list[str] | None = None, manifest_rows=None, base: str = "tables") -> DataFrame:
    """Current rows of ``table`` (optionally only some providers).  The
    manifest is a control table of one row per (table, provider, bucket)."""
    if manifest_rows is None:
        manifest_rows = read_manifest(spark, root).where(F.col("table") == table).collect()
    return _read(spark, root, table, schema,
                 [r for r in manifest_rows if providers is None or r["provider"] in providers], base)


def bucket_count(rows: int) -> int:
    """Buckets for so many rows: a power of two."""
    return 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length()


def apply_upserts(spark: SparkSession, root: str, table: str, schema: T.StructType,
                  new: DataFrame, new_rows: dict[str, int], key: list[str],
                  order_cols: list[str], manifest_rows, keyless: list[str] = (),
                  replace_files: DataFrame | None = None, merge=upsert, base: str = "tables") -> list[dict]:
    """Upsert ``new`` into ``table`` and write the changed parts as a new
    version.  ``new_rows``: rows per provider in ``new`` (0 if not counted and
    the provider is known already); ``keyless``:
    providers that declare the table without a key.  Returns the manifest rows
    of these providers after the change, to be committed.

    ``replace_files`` (``provider, _source_file``): loose rows loaded from
    these files are dropped first — the keyless-table option that replaces a
    re-imported file instead of appending it again.  ``merge``: the upsert to
    use (:func:`lading.operators.upsert.upsert` or one of its kind)."""
    cols = schema.names
    providers = sorted(new_rows)
    own = [r for r in manifest_rows if r["table"] == table and r["provider"] in new_rows]
    have: dict[str, int] = {}
    buckets: dict[str, int] = {}
    for r in own:
        if r["bucket"] != LOOSE:
            have[r["provider"]] = have.get(r["provider"], 0) + r["rows"]
            buckets[r["provider"]] = r["buckets"]
    regrown = set()
    for p in providers:
        want = bucket_count(have.get(p, 0) + new_rows[p])
        if p not in buckets or want >= 4 * buckets[p]:
            if p in buckets:
                regrown.add(p)
            buckets[p] = want
    # One row per provider: the join's side is as small as the run's plan.
    counts = spark.createDataFrame([(p, buckets[p]) for p in providers], "provider string, _n int")
    conflicts = complete_key(key) & ~F.col("provider").isin(list(keyless)) if key else F.lit(False)

    def placed(df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*key), F.col("_n")).cast("int") if key else F.lit(LOOSE)
        return df.join(counts, "provider").withColumn(
            "_b", F.when(conflicts, bucket).otherwise(F.lit(LOOSE))).drop("_n")

    new_b = placed(new)
    if all(buckets[p] == 1 for p in providers):
        touched = {(p, 0) for p in providers}
    else:
        touched = {(r["provider"], r["_b"]) for r in new_b.select("provider", "_b").distinct().collect()}
    keyed_new = new_b.where(F.col("_b") != LOOSE)
    stored = [r for r in own if r["bucket"] != LOOSE and r["provider"] not in regrown and (r["provider"], r["bucket"]) in touched]
    if stored and merge is upsert and key:
        changed = _changed_buckets(_read(spark, root, table, schema, stored, base), placed(
            last_wins(keyed_new.drop("_b"), ["provider", *key], order_cols).select(*cols)), ["provider", *key], cols)
        quiet = {(r["provider"], r["bucket"]) for r in stored} - changed
        if quiet:
            touched -= quiet
            left = spark.createDataFrame(sorted(quiet), "provider string, _b int")  # one row per bucket
            keyed_new = keyed_new.join(left, ["provider", "_b"], "left_anti")
    keyed_new = keyed_new.drop("_b")
    rewrite = [r for r in own if r["bucket"] != LOOSE and (r["provider"] in regrown or (r["provider"], r["bucket"]) in touched)]
    replaced = [r for r in own if replace_files is not None and r["bucket"] == LOOSE]
    # The provider is part of every key: providers never conflict.
    merged = merge(_read(spark, root, table, schema, rewrite, base), keyed_new, ["provider", *key],
                   order_cols=order_cols, keep_cols=cols) if key else keyed_new.select(*cols)
    loose = new_b.where(F.col("_b") == LOOSE).select(*cols)
    if replaced:
        kept = _read(spark, root, table, schema, replaced, base).join(replace_files, ["provider", "_source_file"], "left_anti")
        loose = kept.select(*cols).unionByName(loose)
    out = placed(merged).unionByName(loose.withColumn("_b", F.lit(LOOSE)))
    version = next_version(_home(root, base), table)
    path = f"{_home(root, base)}/{table}/v={version:08d}"
    folder = F.substring(F.md5(F.encode("provider", "utf-8")), 1, 16)
    # REBALANCE gathers each bucket's rows into few files and lets AQE split large buckets.
    out.withColumn("_p", folder).hint("rebalance", "_p", "_b").write.partitionBy("_p", "_b").parquet(path)
    # Rows per bucket from the files' footers: no column is read.
    named = {_folder(p): p for p in providers}
    rows_of = (spark.read.schema(T.StructType([*schema.fields, T.StructField("_p", T.StringType()), T.StructField("_b", T.IntegerType())]))
               .parquet(path).groupBy("_p", "_b").agg(F.count(F.lit(1)).alias("rows")).collect())  # one row per bucket
    written = [{"provider": named[r["_p"]], "_b": r["_b"], "rows": r["rows"]} for r in rows_of]
    gone = {(r["provider"], r["bucket"], r["version"]) for r in [*rewrite, *replaced]}
    keep = [r.asDict() if hasattr(r, "asDict") else r for r in own]
    keep = [r | {"buckets": buckets[r["provider"]]} for r in keep if (r["provider"], r["bucket"], r["version"]) not in gone]
    return keep + [
        {"table": table, "provider": r["provider"], "bucket": r["_b"], "buckets": buckets[r["provider"]],
         "version": version, "rows": r["rows"]}
        for r in written
    ]


def _changed_buckets(old: DataFrame, new: DataFrame, key: list[str], cols: list[str]) -> set[tuple[str, int]]:
    """Buckets in which some incoming row (``new``, one per key, with its
    bucket ``_b``) is not stored as it is.  Rows are compared by two 64-bit
    hashes of all columns, so only keys and hashes are shuffled."""

    def hashed(df: DataFrame, *more: str) -> DataFrame:
        # A null hashes like nothing: which columns are null is part of the row.
        nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
        return df.select(*key, *more, F.xxhash64(nulls, *cols).alias("_h1"), F.xxhash64(F.lit(7), nulls, *cols).alias("_h2"))

    fresh = hashed(new, "_b").join(hashed(old), [*key, "_h1", "_h2"], "left_anti")
    return {(r["provider"], r["_b"]) for r in fresh.select("provider", "_b").distinct().collect()}  # one row per bucket


def changed_manifest(spark: SparkSession, manifest_rows, table: str, providers, updates: list[dict]):
    """The manifest with the rows of a table's providers replaced: as rows,
    and as the table to commit."""
    rows = [r.asDict() if hasattr(r, "asDict") else r for r in manifest_rows]
    rows = [r for r in rows if not (r["table"] == table and r["provider"] in providers)] + list(updates)
    rows.sort(key=lambda r: (r["table"], r["provider"], r["bucket"], r["version"]))
    names = MANIFEST_SCHEMA.names
    return rows, spark.createDataFrame([tuple(r[c] for c in names) for r in rows], MANIFEST_SCHEMA)
