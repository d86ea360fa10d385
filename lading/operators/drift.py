"""Schema-drift report: feed headers against declared tables.

Per provider and table, one outcome:

* ``exact_match`` — normalised header equals the declared list, in order;
* ``missing_in_db`` — the header has columns the table lacks;
* ``extra_in_db`` — the table has columns the header lacks;
* ``missing_and_extra`` — both;
* ``order_mismatch`` — same set, other order;
* ``file_not_in_schema`` — a feed file with no declared table;
* ``table_without_file`` — a declared table no feed file fills.

Names on both sides are compared after normalising (BOM off, trimmed, lower
case, only letters, digits and ``_``), files by lower-cased base name.  The import itself
matches headers exactly, so ``importer_exact`` says whether the raw header
equals the declared list as the importer compares it; ``exact_match`` rows
with ``importer_exact = false`` match only after normalising.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.functions.names import last_segment, normalise_header_name
from lading.sources.archive import entry_headers, list_entries, read_archives


def report_entry(name) -> "F.Column":
    n = F.col(name) if isinstance(name, str) else name
    return n.endswith(".txt") & ~n.startswith("__MACOSX") & ~last_segment(n).startswith("._")


def drift_from_landing(spark: SparkSession, landing: str, declared: DataFrame) -> DataFrame:
    """The report over the newest feed version of every provider below
    ``landing``; headers are read from the archives.  A file that cannot be
    read counts as one without a header."""
    archives = read_archives(spark, landing)
    newest = archives.groupBy("provider").agg(
        F.max_by("version", F.struct("modificationTime", "version")).alias("version"))
    entries = list_entries(archives.join(newest, ["provider", "version"])).where(report_entry("file"))
    return drift_report(entry_headers(entries).select("provider", "file", "header"), declared)


def drift_report(headers: DataFrame, declared: DataFrame) -> DataFrame:
    """``headers(provider, file, header array<string>)`` — one row per feed
    file (header NULL or empty when the file has no header line);
    ``declared(provider, table, declared array<string>)``."""
    feed = headers.where(report_entry("file")).select(
        "provider",
        "file",
        F.lower(F.regexp_replace(last_segment("file"), r"\.txt$", "")).alias("table"),
        F.col("header").alias("raw_header"),
        F.filter(F.transform("header", normalise_header_name), lambda x: x != "").alias("csv_columns"),
    )
    decl = declared.select(
        "provider", F.lower("table").alias("table"),
        F.col("declared").alias("raw_declared"),
        F.transform("declared", normalise_header_name).alias("db_columns"),
    )
    providers = feed.select("provider").union(decl.select("provider")).distinct()
    decl = decl.join(providers, "provider", "left_semi")
    j = feed.join(decl, ["provider", "table"], "full_outer")
    missing = F.array_except("csv_columns", "db_columns")
    extra = F.array_except("db_columns", "csv_columns")
    outcome = (
        F.when(F.col("db_columns").isNull(), "file_not_in_schema")
        .when(F.col("file").isNull(), "table_without_file")
        .when(F.col("csv_columns") == F.col("db_columns"), "exact_match")
        .when((F.size(missing) > 0) & (F.size(extra) > 0), "missing_and_extra")
        .when(F.size(missing) > 0, "missing_in_db")
        .when(F.size(extra) > 0, "extra_in_db")
        .otherwise("order_mismatch")
    )
    both = F.col("db_columns").isNotNull() & F.col("file").isNotNull()
    return j.select(
        "provider",
        "table",
        "file",
        outcome.alias("outcome"),
        F.when(both, F.array_sort(missing)).alias("missing_in_db"),
        F.when(both, F.array_sort(extra)).alias("extra_in_db"),
        F.when(both, F.coalesce(F.col("raw_header") == F.col("raw_declared"), F.lit(False))).alias(
            "importer_exact"
        ),
    )
