"""Column functions.  All are built-in Spark expressions (JVM side, codegen);
none is a Python UDF."""

from lading.functions.affinity import integer_affinity, real_affinity, typed_value, NUMERIC_TEXT
from lading.functions.names import (
    binding_name,
    crc32_hex,
    entry_table_name,
    is_feed_entry,
    last_segment,
    normalise_header_name,
    path_segments,
    saturating_sub,
)

__all__ = [
    "NUMERIC_TEXT",
    "binding_name",
    "crc32_hex",
    "entry_table_name",
    "integer_affinity",
    "is_feed_entry",
    "last_segment",
    "normalise_header_name",
    "path_segments",
    "real_affinity",
    "saturating_sub",
    "typed_value",
]
