"""Column names that an input table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
