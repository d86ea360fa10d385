"""Status query: the progress rows of one provider, each also as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class UnknownProvider(LookupError):
    """The provider is not in the catalogue (the HTTP form answers 404)."""


def parse_status_path(path: str) -> str | None:
    """``/<provider>/status`` → provider; anything else → None."""
    parts = path.strip("/").split("/")
    if len(parts) >= 2 and parts[1] == "status":
        return parts[0]
    return None


def provider_status(progress: DataFrame, provider: str, drop: list[str] | None = None) -> DataFrame:
    """All progress rows of ``provider`` plus a ``json`` column holding the
    row (NULL fields kept)."""
    rows = progress.where(F.col("Provider") == provider)
    if drop:
        rows = rows.drop(*drop)
    return rows.withColumn(
        "json", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    )


def status(spark, root: str, provider: str, known: list[str] | None = None) -> DataFrame:
    """Status of one provider from the control tables under ``root``; only the
    provider's part of the progress table is read.
    ``known``: providers of the catalogue; an unknown one raises."""
    from lading.operators.control import PROGRESS_SCHEMA
    from lading.sinks.snapshots import read_table

    if known is not None and provider not in known:
        raise UnknownProvider(f"Provider '{provider}' not found")
    progress = read_table(spark, root, "control/import_progress", PROGRESS_SCHEMA, [provider])
    return provider_status(progress, provider)
