"""JSON arrays of objects as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_rows(df: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """One row per object of the JSON array in column ``payload``: the other
    columns, and ``fields`` (name to type) extracted from the object.
    A field the object lacks is NULL; an empty or invalid array gives no row."""
    keep = [c for c in df.columns if c != payload]
    # Each object stays JSON text, parsed once for all its fields.
    rows = df.select(*keep, F.explode(F.from_json(payload, "array<string>")).alias("_object"))
    texts = rows.select(*keep, F.json_tuple("_object", *fields).alias(*[f"_{name}" for name in fields]))
    return texts.select(*keep, *[F.col(f"_{name}").cast(kind).alias(name) for name, kind in fields.items()])
