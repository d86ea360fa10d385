"""CRC-32 as an associative value.

The CRC of a text follows from those of its pieces: with ``n`` bytes after a
piece, its CRC moves by ``n`` zero bytes — a linear map over GF(2) — and the
moved values of all pieces are XORed (the rule of zlib's ``crc32_combine``).
XOR has no order, so pieces of one entry may lie in any tasks and an ordinary
aggregate puts them together.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lading.session import ship_package

#: The polynomial of CRC-32, lowest power first (fixed by the ZIP format).
POLYNOMIAL = 0xEDB88320
#: Lengths are below 2 ** LENGTH_BITS bytes.
LENGTH_BITS = 48


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for k in range(32):
        if vector >> k & 1:
            out ^= matrix[k]
    return out


@functools.cache
def zero_byte_matrices() -> list[list[int]]:
    """For each bit k of a length, the matrix (its 32 columns) that moves a
    CRC by 2 ** k zero bytes: squares of the matrix of one zero bit."""
    matrix = [POLYNOMIAL] + [1 << k for k in range(31)]
    for _ in range(3):
        matrix = [_times(matrix, column) for column in matrix]
    out = [matrix]
    while len(out) < LENGTH_BITS:
        out.append([_times(out[-1], column) for column in out[-1]])
    return out


def joined_crc32(crc: int, following: int, size: int) -> int:
    """The CRC-32 of a text and the ``size`` bytes after it, from both CRCs."""
    for k, matrix in enumerate(zero_byte_matrices()):
        if size >> k & 1:
            crc = _times(matrix, crc)
    return crc ^ following


def crc32_shift(crc: str, after: str) -> Column:
    """The CRC-32 (long column ``crc``) moved by ``after`` zero bytes."""
    table = ", ".join(f"array({', '.join(f'{c}L' for c in m)})" for m in zero_byte_matrices())
    moved = f"aggregate(sequence(0, 31), 0L, (a, i) -> a ^ ((shiftrightunsigned(c, i) & 1L) * array({table})[k][i]))"
    return F.expr(f"aggregate(sequence(0, {LENGTH_BITS - 1}), `{crc}`, (c, k) -> if((shiftrightunsigned(`{after}`, k) & 1L) = 1L, {moved}, c))")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of successive records of one entry in a batch."""
    for b in batches:
        out = []
        entry = None
        for provider, file, number, line in zip(*[c.to_pylist() for c in b.columns], strict=True):
            text = (line or "").encode("utf-8", "surrogatepass") + b"\n"
            if entry == (provider, file) and number == at + 1:
                crc, size, records = zlib.crc32(text, crc), size + len(text), records + 1
            else:
                if entry is not None:
                    out.append((*entry, first, crc, size, records))
                entry, first, crc, size, records = (provider, file), number, zlib.crc32(text), len(text), 1
            at = number
        if entry is not None:
            out.append((*entry, first, crc, size, records))
        columns = zip(*out, strict=True) if out else [[]] * 6
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["provider", "file", "first", "crc", "bytes", "records"])


def record_pieces(lines: DataFrame) -> DataFrame:
    """Pieces of entries from their records ``(provider, file, line_no, line)``,
    wherever they lie: the CRC-32 and length of each run of successive records,
    every record ended by LF.  Nothing is shuffled."""
    ship_package(lines.sparkSession)
    return lines.select("provider", "file", "line_no", "line").mapInArrow(
        _pieces, "provider string, file string, first long, crc long, bytes long, records long")


def combine_crc32(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys``: crc (eight hex digits), bytes and records of the pieces
    (``first`` orders them, ``crc``, ``bytes``, ``records``).  Only pieces, a few
    per task and entry, pass the window; their values are combined by XOR."""
    later = Window.partitionBy(*keys).orderBy(F.desc("first")).rowsBetween(Window.unboundedPreceding, -1)
    moved = pieces.withColumn("after", F.coalesce(F.sum("bytes").over(later), F.lit(0)).cast("long"))
    return moved.withColumn("moved", crc32_shift("crc", "after")).groupBy(*keys).agg(
        F.lower(F.lpad(F.hex(F.bit_xor("moved")), 8, "0")).alias("crc"), F.sum("bytes").alias("bytes"), F.sum("records").alias("records"))
