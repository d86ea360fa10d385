"""String and integer helpers on columns: entry names, table names,
checksums, binding names, request paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def last_segment(name) -> Column:
    """Base name of an archive entry: the part after the last ``/``."""
    return F.substring_index(_c(name), "/", -1)


def is_feed_entry(name) -> Column:
    """Entry filter: a ``.txt`` file, not below ``__MACOSX``, and whose base
    name does not start with ``._`` (resource-fork files)."""
    n = _c(name)
    return (
        n.endswith(".txt")
        & ~n.contains("__MACOSX")
        & ~last_segment(n).startswith("._")
    )


def entry_table_name(name) -> Column:
    """Table name of an entry: the full entry path without ``.txt``.  Case is
    kept, and so is a directory: ``dir/stops.txt`` names table ``dir/stops``,
    which the registry does not know."""
    return F.regexp_replace(_c(name), r"\.txt$", "")


def crc32_hex(data) -> Column:
    """CRC-32 as eight lower-case hex digits (``hello`` -> ``3610a686``)."""
    return F.lower(F.lpad(F.hex(F.crc32(_c(data))), 8, "0"))


def saturating_sub(a, b) -> Column:
    """``a - b``, never below zero."""
    return F.greatest(_c(a) - _c(b), F.lit(0))


def binding_name(provider) -> Column:
    """Name under which a provider's store is addressed: ``DB_`` + upper case,
    ``-`` replaced by ``_``."""
    return F.concat(F.lit("DB_"), F.upper(F.translate(_c(provider), "-", "_")))


def path_segments(path) -> Column:
    """Request path without surrounding ``/``, split on ``/``."""
    return F.split(F.btrim(_c(path), F.lit("/")), "/")


def normalise_header_name(name) -> Column:
    """Header name as the drift report compares it: BOM off, trimmed, lower
    case, only letters, digits and ``_`` kept."""
    n = F.regexp_replace(_c(name), "^﻿", "")
    return F.regexp_replace(F.lower(F.trim(n)), r"[^\p{L}\p{N}_]", "")
