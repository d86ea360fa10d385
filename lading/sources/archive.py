"""Feed archives: ZIPs of CSV files in a landing folder.

Layout: ``<landing>/provider=<name>/version=<version>/<any>.zip``.  The
version is whatever identifies the feed release (an ETag, a date); a new
release lands in a new folder, never over an old one.

* :func:`read_archives` — the ``binaryFile`` source, one row per archive.
* :func:`list_entries` — one row per archive entry (name, CRC-32, size),
  read from the ZIP's central directory; no entry is decompressed and only
  the directory at the end of the archive is read.
* :func:`expand_entries` — one row per CSV record of the wanted entries.
  Deflate is not splittable, so each wanted entry is expanded by one task as
  a stream of Arrow batches (memory is bounded by the batch size and the
  longest record, not the entry size).  The task opens the archive by path and
  reads only its member: archive bytes never travel through a shuffle.  Records
  are numbered here, in file order, so no later step needs a per-file sort.
  An entry that cannot be read to its end (broken archive or member, wrong
  CRC-32, storage fault) ends with one error row; its siblings go on.
* :func:`write_archives` — the reverse, used to land tables as feeds: each
  Spark partition writes its own archive.
* :func:`write_archives_in_pieces` — the same for large members: every task
  deflates what it has of each archive, and the pieces are put together.
"""

from __future__ import annotations

import heapq
import re
import time
import zipfile
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.functions.crc import joined_crc32
from lading.session import scratch_path, ship_package
from lading.sources.fs import exists, move, open_input, open_output, remove_dir

ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("provider", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)

ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("archive", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("crc", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

LINE_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("line", T.StringType()),
        T.StructField("bad_utf8", T.BooleanType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
        T.StructField("n_fields", T.IntegerType()),
        T.StructField("odd", T.BooleanType()),
    ]
)
#: ``line_no`` of the row that reports an entry's failure, and of the row that
#: ends an entry read to its end (``line`` holds the last record's number).
ERROR_LINE, END_LINE = -1, -2

BATCH_ROWS = 65536
CHUNK_BYTES = 1 << 22

# The records of a CSV reader: CR, LF and CRLF end a record outside quotes; a
# field is quoted if it starts with a quote; doubled quotes stand for one;
# bytes inside quotes stay as they are; text after the closing quote continues
# the field.  Possessive repeats: every byte is looked at once.
_REST = rb"[^,\r\n]*+"
_QUOTED = rb'"[^"]*+(?:""[^"]*+)*+"' + _REST
_FIELD = rb"(?:" + _QUOTED + rb'|(?!")' + _REST + rb")"
_RECORD = re.compile(rb"(" + _FIELD + rb"(?:," + _FIELD + rb")*+)(?:\r\n|\r|\n)")
# Finds a physical line that is not a whole record, i.e. a quote left open.
_LINE_FIELD = rb'(?:"[^"\r\n]*+(?:""[^"\r\n]*+)*+"' + _REST + rb'|(?!")' + _REST + rb")"
_OPEN_LINE = re.compile(rb"(?:\A|(?<=[\r\n]))(?!" + _LINE_FIELD + rb"(?:," + _LINE_FIELD + rb")*+(?:[\r\n]|\Z))")
_BOM = b"\xef\xbb\xbf"
# What reading an archive member can raise for data or storage that is broken.
_READ_ERRORS = (zipfile.BadZipFile, zipfile.LargeZipFile, KeyError, OSError, EOFError, ValueError,
                NotImplementedError, RuntimeError, zlib.error)


def read_archives(spark: SparkSession, landing: str) -> DataFrame:
    """``binaryFile`` rows of the archives below ``landing``; ``provider``
    and ``version`` come from the folder names and stay strings."""
    return (
        spark.read.format("binaryFile")
        .schema(ARCHIVE_SCHEMA)
        .option("pathGlobFilter", "*.zip")
        .load(landing)
    )


def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {f: [] for f in ENTRY_SCHEMA.names}
        cols = b.to_pydict()
        for provider, version, path in zip(cols["provider"], cols["version"], cols["path"]):
            try:
                with open_input(path) as fh:
                    infos = zipfile.ZipFile(fh).infolist()
            except _READ_ERRORS as exc:
                for name, value in zip(ENTRY_SCHEMA.names, (provider, version, path, None, None, None, f"{type(exc).__name__}: {exc}")):
                    out[name].append(value)
                continue
            for info in infos:
                if info.is_dir():
                    continue
                out["error"].append(None)
                out["provider"].append(provider)
                out["version"].append(version)
                out["archive"].append(path)
                out["file"].append(info.filename)
                out["crc"].append(f"{info.CRC:08x}")
                out["size"].append(info.file_size)
        yield pa.RecordBatch.from_pydict(out, schema=_arrow(ENTRY_SCHEMA))


def _arrow(schema: T.StructType) -> pa.Schema:
    m = {
        T.StringType: pa.string(),
        T.LongType: pa.int64(),
        T.BooleanType: pa.bool_(),
        T.IntegerType: pa.int32(),
    }
    fields = []
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            fields.append(pa.field(f.name, pa.list_(pa.string())))
        else:
            fields.append(pa.field(f.name, m[type(f.dataType)]))
    return pa.schema(fields)


def list_entries(archives: DataFrame) -> DataFrame:
    """One row per entry: ``(provider, version, archive, file, crc, size,
    error)``.  An archive that cannot be read (not an archive, storage fault)
    gives one row without a file, with the ``error``."""
    ship_package(archives.sparkSession)
    return archives.select("provider", "version", "path").mapInArrow(_list_batches, ENTRY_SCHEMA)


def _record_blocks(stream, chunk: int = CHUNK_BYTES) -> Iterator[tuple]:
    """CSV records of a byte stream, one block of input at a time.

    Yields ``(body, None)`` for a block in which every physical line is a
    record (lines end with LF there), so the caller can decode and split it at
    once, or ``(None, records)`` otherwise.  While a quote stays open the next
    read is as long as what is held, so a record of any length costs time in
    proportion to it.  A quote that is never closed makes the rest of the
    stream one record.  A leading UTF-8 BOM is dropped.
    """
    data = stream.read(chunk)
    data = data.removeprefix(_BOM)
    while True:
        block = stream.read(max(chunk, len(data)))
        cut = max(data.rfind(b"\n"), data.rfind(b"\r"))
        if not block and not data:
            return
        body, rest = (data, b"") if not block else (data[:cut], data[cut + 1:])
        if (not block or cut >= 0) and (b'"' not in body or _OPEN_LINE.search(body) is None):
            if b"\r" in body:
                body = body.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            yield body, None
            data = rest + block
        else:
            recs, at = [], 0
            # a CR that ends what is held may be half of a CRLF
            end = len(data) - (1 if block and data.endswith(b"\r") else 0)
            while (m := _RECORD.match(data, at, end)) is not None:
                recs.append(m[1])
                at = m.end()
            if not block and at < len(data):
                recs.append(data[at:])
                at = len(data)
            if recs:
                yield None, recs
            data = data[at:] + block
        if not block:
            return


def _records(stream, chunk: int = CHUNK_BYTES) -> Iterator[bytes]:
    """CSV records of a byte stream (see :func:`_record_blocks`)."""
    for body, recs in _record_blocks(stream, chunk):
        yield from (body.split(b"\n") if body is not None else recs)


def _decode(body, recs) -> tuple[list[str], list[bool] | None]:
    """Text of the records and, if any record is not UTF-8, a flag each."""
    if body is not None:
        try:
            return body.decode("utf-8").split("\n"), None
        except UnicodeDecodeError:
            recs = body.split(b"\n")
    try:
        return [r.decode("utf-8") for r in recs], None
    except UnicodeDecodeError:
        texts, bad = [], []
        for r in recs:
            try:
                texts.append(r.decode("utf-8"))
                bad.append(False)
            except UnicodeDecodeError:
                texts.append(r.decode("utf-8", errors="replace"))
                bad.append(True)
        return texts, bad


def arities(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fields of each record, and whether it is odd: text after a closing
    quote, a quote left open, or a line end inside quotes.  Whole fields in
    quotes are replaced by a mark; what is left tells both."""
    quoted = np.asarray(pc.match_substring(texts, '"'))
    odd = np.zeros(len(texts), bool)
    marked = texts
    if quoted.any():
        marked = pc.replace_substring_regex(texts, r'(^|,)"[^"]*(?:""[^"]*)*"', "\\1\x00")
        odd = quoted & np.asarray(pc.match_substring_regex(marked, '\x00[^,]|(?:^|,)"|[\r\n]'))
        odd |= quoted & np.asarray(pc.match_substring_regex(texts, "[\r\n]"))
    fields = np.asarray(pc.count_substring(marked, ",")).astype(np.int32) + 1
    for k in np.flatnonzero(odd).tolist():
        fields[k] = len(split_record(texts[k].as_py()))
    return fields, odd


def _entry_batches(stream, provider, version, file, chunk: int = CHUNK_BYTES):
    """Arrow batches of one entry's records, numbered from 0 (the header)."""
    schema = _arrow(LINE_SCHEMA)
    next_no = 0
    for body, recs in _record_blocks(stream, chunk):
        texts, bad = _decode(body, recs)
        if "" in texts:  # blank lines are not records
            keep = [i for i, t in enumerate(texts) if t]
            texts = [texts[i] for i in keep]
            bad = [bad[i] for i in keep] if bad is not None else None
        for lo in range(0, len(texts), BATCH_ROWS):
            part = texts[lo:lo + BATCH_ROWS]
            n = len(part)
            flags = bad[lo:lo + BATCH_ROWS] if bad is not None else None
            headers = pa.nulls(n, pa.list_(pa.string()))
            if next_no == 0:
                first_bad = flags[0] if flags is not None else False
                hdr = [] if first_bad else split_record(part[0])
                headers = pa.array([hdr] + [None] * (n - 1), pa.list_(pa.string()))
            lines = pa.array(part, pa.string())
            fields, odd = arities(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    _same(provider, n),
                    _same(version, n),
                    _same(file, n),
                    pa.array(np.arange(next_no, next_no + n, dtype=np.int64)),
                    lines,
                    pa.array(flags if flags is not None else np.zeros(n, dtype=bool), pa.bool_()),
                    headers,
                    pa.nulls(n, pa.string()),
                    pa.array(fields, pa.int32()),
                    pa.array(odd),
                ],
                schema=schema,
            )
            next_no += n
    yield _outcome_batch(provider, version, file, END_LINE, str(max(next_no - 1, 0)), None)


def _same(value: str | None, n: int) -> pa.Array:
    return pa.nulls(n, pa.string()) if value is None else pa.repeat(pa.scalar(value, pa.string()), n)


def split_record(record: str) -> list[str]:
    """Fields of one record (the rules above)."""
    out = []
    for m in _SPLIT.finditer("," + record):
        quoted, rest, plain = m.groups()
        out.append(plain if quoted is None else quoted.replace('""', '"') + (rest or ""))
    return out


# One field with its leading comma; an open quote takes the rest.
_SPLIT = re.compile(r',(?:"([^"]*+(?:""[^"]*+)*+)(?:"([^,]*+)|\Z)|([^,]*+))')


def _outcome_batch(provider, version, file, line_no: int, line: str | None, error: str | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"provider": provider, "version": version, "file": file, "line_no": line_no,
          "line": line, "bad_utf8": False, "header": None, "error": error}],
        schema=_arrow(LINE_SCHEMA))


def _expand_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns after the first four are carried to every record."""
    for b in batches:
        carried = b.schema.names[4:]
        for provider, version, archive, file, *values in zip(*[c.to_pylist() for c in b.columns]):
            try:
                # ZipExtFile checks the member's CRC-32 when it reaches its end.
                with open_input(archive) as fh, zipfile.ZipFile(fh).open(file) as stream:
                    for out in _entry_batches(stream, provider, version, file):
                        yield _with(out, carried, values)
            except _READ_ERRORS as exc:
                yield _with(_outcome_batch(provider, version, file, ERROR_LINE, None, f"{type(exc).__name__}: {exc}"), carried, values)


def _with(batch: pa.RecordBatch, names: list[str], values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *[_same(v, batch.num_rows) for v in values]], names=[*batch.schema.names, *names])


def _bins(sizes: list[int], n: int) -> list[int]:
    """Bin of each entry: the largest first, each into the lightest bin."""
    heap = [(0, k) for k in range(n)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, k = heapq.heappop(heap)
        out[i] = k
        heapq.heappush(heap, (load + max(1, sizes[i]), k))
    return out


#: An entry of at least this part of a task's fair share is dealt by size.
LARGE_SHARE = 0.25


def _dealt(wanted: DataFrame, names: list[str]) -> tuple[DataFrame, int]:
    """``wanted`` with the task (``bin``) of each entry, and their number.

    Large entries are dealt by size, the largest first; there are fewer than
    tasks / ``LARGE_SHARE`` of them, however many entries there are.  The
    others are dealt by a hash: each is a small part of a task's share."""
    spark = wanted.sparkSession
    total = wanted.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    n = max(1, min(total["n"], spark.sparkContext.defaultParallelism * 8))
    least = max(1, int((total["bytes"] or 0) * LARGE_SHARE / n))
    large = wanted.where(F.col("size") >= least).select("provider", "version", "archive", "file", "size").orderBy("provider", "version", "archive", "file").collect()
    bins = _bins([r["size"] for r in large], n)
    dealt = spark.createDataFrame([(*r[:4], k) for r, k in zip(large, bins)], ", ".join(f"{c} string" for c in names[:4]) + ", _bin int")
    key = [F.coalesce(c, F.lit("")) for c in names[:4]]
    entry = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in names[:4]]
    marked = wanted.withColumn("_key", F.struct(*key)).join(
        F.broadcast(dealt.select(F.struct(*entry).alias("_key"), "_bin")), "_key", "left")  # bounded by the number of tasks
    return marked.select(*names, F.coalesce("_bin", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")).alias("bin")), n


def expand_entries(wanted: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Records of the wanted entries.

    ``wanted``: ``(provider, version, archive, file[, size])`` — one row per
    entry to expand; string columns named in ``carry`` come with every record.
    Entries are dealt to tasks by size, the largest first; there are as many
    tasks as entries, up to a few waves of the cluster's cores.  Output follows
    ``LINE_SCHEMA``: ``line_no`` 0 is the header record (with ``header``
    parsed), data records follow from 1; blank lines are skipped; ``bad_utf8``
    marks records that are not UTF-8; ``n_fields`` and ``odd`` say how many
    fields a record has and whether it needs the full splitting rules.
    Each entry has one row more: ``END_LINE`` with the number of its last
    record, or ``ERROR_LINE`` with an ``error`` if it could not be read to the
    end.
    """
    ship_package(wanted.sparkSession)
    names = ["provider", "version", "archive", "file", *carry]
    size = F.coalesce(F.col("size"), F.lit(0)) if "size" in wanted.columns else F.lit(0)
    rows, n = _dealt(wanted.select(*names, size.cast("long").alias("size")), names)
    schema = T.StructType([*LINE_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in carry]])
    return rows.repartitionById(n, F.col("bin")).select(*names).mapInArrow(_expand_batches, schema)


HEADER_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)


def _header_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for r in b.to_pylist():
            header, error = None, None
            try:
                with open_input(r["archive"]) as fh, zipfile.ZipFile(fh).open(r["file"]) as stream:
                    first = next((x for x in _records(stream, 1 << 16) if x), None)
                header = None if first is None else split_record(first.decode("utf-8"))
            except _READ_ERRORS as exc:
                error = f"{type(exc).__name__}: {exc}"
            out.append({"provider": r["provider"], "version": r["version"], "file": r["file"], "header": header, "error": error})
        yield pa.RecordBatch.from_pylist(out, schema=_arrow(HEADER_SCHEMA))


def entry_headers(wanted: DataFrame) -> DataFrame:
    """First record of each wanted entry ``(provider, version, archive,
    file)``, split into names; only the entry's first block is decompressed.
    ``header`` is NULL for an empty entry, or with an ``error``."""
    ship_package(wanted.sparkSession)
    return wanted.select("provider", "version", "archive", "file").mapInArrow(_header_batches, HEADER_SCHEMA)


# --- landing tables as feeds ---------------------------------------------------

def _spoil(archive: str) -> None:
    """Overwrite the first bytes of the archive's one member (after its local
    header), as a storage fault would."""
    with open_input(archive) as fh:
        data = bytearray(fh.read())
    at = 30 + int.from_bytes(data[26:28], "little") + int.from_bytes(data[28:30], "little")
    data[at: at + 4] = b"\xff" * 4
    with open_output(archive) as out:
        out.write(bytes(data))


def _zip_writer(landing: str, version: str, entry: str, header: str, prefix: str, damaged: tuple[int, ...]):
    from pyspark import TaskContext

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        pid = ctx.partitionId()
        provider = f"{prefix}{pid}"
        path = f"{landing.rstrip('/')}/provider={provider}/version={version}/{entry}.zip"
        # Each attempt writes its own file and moves it into place when
        # complete: a lost or speculative attempt never leaves a half archive
        # under the name readers look for.
        tmp = f"{path}.attempt-{ctx.attemptNumber()}-{ctx.taskAttemptId()}"
        rows = 0
        out = None
        zf = None
        member = None
        for b in batches:
            if out is None:
                out = open_output(tmp)
                zf = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED)
                member = zf.open(f"{entry}.txt", "w", force_zip64=True)
                member.write(header.encode("utf-8") + b"\n")
            lines = b.column(0).to_pylist()
            if lines:
                member.write(("\n".join(lines) + "\n").encode("utf-8"))
            rows += len(lines)
        if out is not None:
            member.close()
            zf.close()
            out.close()
            if pid in damaged:
                _spoil(tmp)
            move(tmp, path)
            yield pa.RecordBatch.from_pydict(
                {"provider": [provider], "archive": [path], "rows": [rows]},
                schema=pa.schema([("provider", pa.string()), ("archive", pa.string()), ("rows", pa.int64())]),
            )

    return write


def write_archives(lines: DataFrame, landing: str, version: str, entry: str,
                   header: str, provider_prefix: str, damaged: tuple[int, ...] = ()) -> DataFrame:
    """Write ``lines`` (one string column, CSV records) as feed archives, one
    per Spark partition: provider ``<provider_prefix><partition>``, entry
    ``<entry>.txt`` with ``header`` first.  Returns ``(provider, archive,
    rows)`` once the write action runs; the archives of the ``damaged``
    partitions get a broken member (to try out failures); call ``.collect()`` or ``.count()``
    on it — the result has one row per partition."""
    ship_package(lines.sparkSession)
    return lines.mapInArrow(
        _zip_writer(landing, version, entry, header, provider_prefix, damaged),
        "provider string, archive string, rows long",
    )


PIECE_SCHEMA = "provider string, at int, path string, crc long, bytes long, packed long, rows long"


def _piece_writer(folder: str, prefix: str):
    """Writes one file per archive that a task has lines of: a deflate stream
    without its last block, so that files joined in any order are one stream."""
    from pyspark import TaskContext

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        files: dict[int, tuple] = {}
        state: dict[int, list[int]] = {}  # crc, bytes, packed, rows
        for b in batches:
            archive = b.column(0).to_numpy()
            for k in np.unique(archive).tolist():
                lines = b.column(1).filter(pa.array(archive == k)).to_pylist()
                text = ("\n".join(lines) + "\n").encode("utf-8")
                if k not in files:
                    path = f"{folder}/{prefix}{k}/{ctx.partitionId()}-{ctx.taskAttemptId()}"
                    files[k] = path, open_output(path), zlib.compressobj(wbits=-zlib.MAX_WBITS)
                    state[k] = [0, 0, 0, 0]
                _, out, deflate = files[k]
                packed = deflate.compress(text)
                out.write(packed)
                crc, size, all_packed, rows = state[k]
                state[k] = [zlib.crc32(text, crc), size + len(text), all_packed + len(packed), rows + len(lines)]
        for k, (path, out, deflate) in files.items():
            packed = deflate.flush(zlib.Z_FULL_FLUSH)
            out.write(packed)
            out.close()
            crc, size, all_packed, rows = state[k]
            yield pa.RecordBatch.from_pydict({
                "provider": [f"{prefix}{k}"], "at": pa.array([ctx.partitionId()], pa.int32()), "path": [path], "crc": [crc], "bytes": [size],
                "packed": [all_packed + len(packed)], "rows": [rows]})

    return write


def _assembler(landing: str, version: str, entry: str, header: str, damaged: tuple[str, ...]):
    """Puts the pieces of one archive together.  Only deflated bytes are copied,
    a chunk at a time; sizes and CRC-32 follow from those of the pieces."""
    from pyspark import TaskContext

    def assemble(pieces: pa.Table) -> pa.Table:
        ctx = TaskContext.get()
        rows = sorted(pieces.to_pylist(), key=lambda r: r["at"])
        provider = rows[0]["provider"]
        path = f"{landing.rstrip('/')}/provider={provider}/version={version}/{entry}.zip"
        tmp = f"{path}.attempt-{ctx.attemptNumber()}-{ctx.taskAttemptId()}"
        head = header.encode("utf-8") + b"\n"
        deflate = zlib.compressobj(wbits=-zlib.MAX_WBITS)
        first = deflate.compress(head) + deflate.flush(zlib.Z_FULL_FLUSH)
        last = zlib.compressobj(wbits=-zlib.MAX_WBITS).flush()
        info = zipfile.ZipInfo(f"{entry}.txt", time.localtime()[:6])
        info.compress_type, info.header_offset = zipfile.ZIP_DEFLATED, 0
        info.CRC, info.file_size = zlib.crc32(head), len(head)
        for r in rows:
            info.CRC = joined_crc32(info.CRC, r["crc"], r["bytes"])
            info.file_size += r["bytes"]
        info.compress_size = len(first) + sum(r["packed"] for r in rows) + len(last)
        with open_output(tmp) as out, zipfile.ZipFile(out, "w") as zf:
            zf.fp.write(info.FileHeader(zip64=True))
            zf.fp.write(first)
            for r in rows:
                with open_input(r["path"]) as piece:
                    while chunk := piece.read(CHUNK_BYTES):
                        zf.fp.write(chunk)
            zf.fp.write(last)
            zf.start_dir = zf.fp.tell()  # the directory follows the member
            zf.filelist.append(info)
            zf.NameToInfo[info.filename] = info
        if provider in damaged:
            _spoil(tmp)
        move(tmp, path)
        return pa.table({"provider": [provider], "archive": [path], "rows": [sum(r["rows"] for r in rows)]})

    return assemble


def write_archives_in_pieces(lines: DataFrame, landing: str, version: str, entry: str,
                             header: str, provider_prefix: str, damaged: tuple[int, ...] = ()) -> None:
    """Write ``lines`` (``archive`` int, ``line`` string: CSV records) as one feed
    archive per number: provider ``<provider_prefix><archive>``, entry
    ``<entry>.txt`` with ``header`` first.  No line is shuffled: each task
    deflates its own lines into a piece per archive, so a member may be larger
    than what one task should read.  Lines lie in the order of the tasks'
    partitions.  For few archives: a task holds a file open for each.  The
    ``damaged`` archives get a broken member."""
    spark = lines.sparkSession
    ship_package(spark)
    folder = scratch_path(spark, "pieces")
    pieces = lines.select("archive", "line").mapInArrow(_piece_writer(folder, provider_prefix), PIECE_SCHEMA)
    pieces.groupBy("provider").applyInArrow(
        _assembler(landing, version, entry, header, tuple(f"{provider_prefix}{k}" for k in damaged)),
        "provider string, archive string, rows long").collect()  # one row per archive
    if exists(folder):
        remove_dir(folder)
