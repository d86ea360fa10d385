"""Versioned table folders: every write goes to a new folder, readers take
the one the newest commit names.

``<root>/<name>/v=<n>/`` holds a version of a table; ``<root>/_commits/c=<n>``
is a small JSON file naming the current version of every table.  Several
tables written by :func:`write_tables` become current in one commit: the file
is written aside and moved into place.  A job never overwrites a folder, and a
folder left half-written by a killed job is passed over: the next version is
numbered past all folders that exist.  One writer at a time per root.

A table may be kept in parts by the hash of a key column (:class:`Parted`): a write
then replaces only the parts of the keys it names, and the commit names a
version per part (``<name>/_p=<part>``), stored in ``v=<n>/_p=<part>/``.

Old versions stay until :func:`vacuum` removes them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lading.sources.fs import exists, list_dirs, list_files, move, open_input, open_output, remove_dir

_COMMITS = "_commits"
#: Parts of a parted table.
PARTS = 64
_PART = "/_p="


def _numbered(root: str, name: str) -> list[int]:
    """Numbers of all version folders of a table, complete or not."""
    return sorted(int(d[2:]) for d in list_dirs(f"{root.rstrip('/')}/{name}") if d.startswith("v=") and d[2:].isdigit())


def _versions(root: str, name: str) -> list[int]:
    """Numbers of the complete version folders."""
    base = f"{root.rstrip('/')}/{name}"
    return [n for n in _numbered(root, name) if exists(f"{base}/v={n:08d}/_SUCCESS")]


def next_version(root: str, name: str) -> int:
    have = _numbered(root, name)
    return have[-1] + 1 if have else 1


def _commit_numbers(root: str) -> list[int]:
    names = list_files(f"{root.rstrip('/')}/{_COMMITS}")
    return sorted(int(n[2:]) for n in names if n.startswith("c=") and n[2:].isdigit())


def _committed(root: str, number: int | None = None) -> dict[str, int]:
    """Table versions named by a commit (the newest by default)."""
    have = _commit_numbers(root)
    if not have:
        return {}
    with open_input(f"{root.rstrip('/')}/{_COMMITS}/c={number or have[-1]:08d}") as fh:
        return json.loads(fh.read())


def current_path(root: str, name: str) -> str | None:
    v = _committed(root).get(name)
    return f"{root.rstrip('/')}/{name}/v={v:08d}" if v else None


@dataclass
class Parted:
    """A table kept in parts by the hash of ``key_col``.  ``keys``: those whose
    rows may have changed.  Their parts are replaced by the rows of ``rows`` that
    fall into them (all rows of these parts must be among them); the other parts
    stay as they are and need not be given."""

    rows: DataFrame
    key_col: str
    keys: Iterable[str | None]


def part_of(key: str | None) -> int:
    """Part of a key; a null key counts as the empty text."""
    return int(hashlib.md5((key or "").encode("utf-8")).hexdigest()[:8], 16) % PARTS


def _part_column(key_col: str) -> Column:
    digest = F.md5(F.encode(F.coalesce(F.col(key_col), F.lit("")), "utf-8"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % PARTS).cast("int")


def _parts(commit: dict[str, int], name: str) -> dict[int, int]:
    """Version of each part of a parted table."""
    return {int(k[len(name) + len(_PART):]): v for k, v in commit.items() if k.startswith(name + _PART)}


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType,
               keys: Iterable[str | None] | None = None) -> DataFrame:
    """The current rows of a table.  ``keys``: of a parted table only the parts
    that hold these keys are listed and read (they may hold other keys too)."""
    return read_committed(spark, root, name, schema, _committed(root), keys)


def read_committed(spark: SparkSession, root: str, name: str, schema: T.StructType, commit: dict[str, int],
                   keys: Iterable[str | None] | None = None) -> DataFrame:
    """The rows of a table as a commit names them."""
    base = f"{root.rstrip('/')}/{name}"
    wanted = None if keys is None else {part_of(k) for k in keys}
    parts = {p: v for p, v in _parts(commit, name).items() if wanted is None or p in wanted}
    out = []
    if name in commit:
        out.append(spark.read.schema(schema).parquet(f"{base}/v={commit[name]:08d}"))
    if parts:
        rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField("_p", T.IntegerType())])).option("basePath", base)
                .parquet(*[f"{base}/v={v:08d}{_PART}{p}" for p, v in sorted(parts.items())]))
        if wanted is not None:
            rows = rows.where(F.col("_p").isin(sorted(wanted)))
        out.append(rows.select(*schema.names))
    if not out:
        return spark.createDataFrame([], schema)
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def write_tables(tables: dict[str, DataFrame | Parted], root: str) -> None:
    """Write new versions of several tables and commit them together.  A table
    that was written whole before is parted by its first write as
    :class:`Parted`, which must give all its rows."""
    commit = _committed(root)
    for name, df in tables.items():
        version = next_version(root, name)
        path = f"{root.rstrip('/')}/{name}/v={version:08d}"
        if not isinstance(df, Parted):
            df.write.mode("errorifexists").parquet(path)
            commit[name] = version
            continue
        touched = set(range(PARTS)) if name in commit else {part_of(k) for k in df.keys}
        if not touched:
            continue
        rows = df.rows.withColumn("_p", _part_column(df.key_col)).where(F.col("_p").isin(sorted(touched)))
        rows.hint("rebalance", "_p").write.mode("errorifexists").partitionBy("_p").parquet(path)
        written = {int(d[3:]) for d in list_dirs(path) if d.startswith("_p=")}
        commit = {k: v for k, v in commit.items() if k != name and not (k.startswith(name + _PART) and int(k.rsplit("=", 1)[1]) in touched)}
        commit |= {f"{name}{_PART}{p}": version for p in written}
    have = _commit_numbers(root)
    path = f"{root.rstrip('/')}/{_COMMITS}/c={(have[-1] if have else 0) + 1:08d}"
    aside = f"{root.rstrip('/')}/{_COMMITS}/writing-{uuid.uuid4().hex}"
    with open_output(aside) as out:
        out.write(json.dumps(commit, sort_keys=True).encode("utf-8"))
    move(aside, path)


def write_table(df: DataFrame, root: str, name: str) -> str:
    """Write a new version of one table; returns its folder."""
    write_tables({name: df}, root)
    return current_path(root, name)


def kept_commits(root: str, keep: int = 2) -> list[dict[str, int]]:
    """What the newest ``keep`` commits name, oldest first."""
    return [_committed(root, n) for n in _commit_numbers(root)[-max(1, keep):]]


def vacuum(root: str, keep: int = 2) -> list[str]:
    """Remove version folders (of parted tables: parts of them) that none of the
    newest ``keep`` commits names.  Returns the folders removed.  No other job
    may write meanwhile."""
    named = {(k, v) for c in kept_commits(root, keep) for k, v in c.items()}
    removed = []
    for name in sorted({k.split(_PART)[0] for k, _ in named}):
        for n in _numbered(root, name):
            path = f"{root.rstrip('/')}/{name}/v={n:08d}"
            parts = [p for p in list_dirs(path) if p.startswith("_p=")]
            held = [p for p in parts if (f"{name}/{p}", n) in named]
            if (name, n) in named or (parts and len(held) == len(parts)):
                continue
            for gone in [f"{path}/{p}" for p in parts if p not in held] if held else [path]:
                remove_dir(gone)
                removed.append(gone)
    return removed
