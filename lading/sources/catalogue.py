"""Provider catalogue: which feeds exist, where they come from, which are
active.  A catalogue is a small table (one row per provider); it is read from
a TOML file in the usual ``[[providers]]`` form, or from rows."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.sources.fs import open_input

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("static_url", T.StringType(), False),
        T.StructField("static_provider", T.StringType(), False),
        T.StructField("database_id", T.StringType(), False),
    ]
)
REQUIRED = ("name", "static_url", "static_provider", "database_id")


def catalogue_rows(entries: list[dict]) -> list[tuple]:
    """Validate catalogue entries: every required field present (a missing
    one fails the whole load), ``is_active`` false unless given."""
    rows = []
    for i, e in enumerate(entries):
        missing = [k for k in REQUIRED if k not in e]
        if missing:
            raise ValueError(f"provider entry {i}: missing {', '.join(missing)}")
        rows.append((e["name"], bool(e.get("is_active", False)), e["static_url"],
                     e["static_provider"], e["database_id"]))
    return rows


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    with open_input(path) as fh:
        doc = tomllib.loads(fh.read().decode("utf-8"))
    return spark.createDataFrame(catalogue_rows(doc.get("providers", [])), CATALOGUE_SCHEMA)


def active_providers(catalogue: DataFrame) -> DataFrame:
    """Active providers with a store id, and the URL of their feed
    (``static_url`` followed by ``static_provider``)."""
    return catalogue.where(F.col("is_active") & (F.col("database_id") != "")).select(
        F.col("name").alias("provider"),
        F.concat("static_url", "static_provider").alias("url"),
        "database_id",
    )
