"""File-system access from tasks and the driver for paths Spark also uses
(local, ``file:``, ``hdfs://``, ``s3://`` …), through ``pyarrow.fs``."""

from __future__ import annotations

import os

import pyarrow.fs as pafs


# Hadoop spellings of object-store schemes that pyarrow knows by another name.
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://"}


def _resolve(path: str):
    for hadoop, arrow in _SCHEMES.items():
        if path.startswith(hadoop):
            path = arrow + path[len(hadoop):]
    if "://" in path and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    local = path[len("file:"):] if path.startswith("file:") else path
    while local.startswith("//"):
        local = local[1:]
    return pafs.LocalFileSystem(), os.path.abspath(local)


def open_input(path: str):
    """A seekable reader: ZIP readers jump to the central directory and to one
    member instead of reading the whole archive."""
    fs, p = _resolve(path)
    return fs.open_input_file(p)


def open_output(path: str):
    fs, p = _resolve(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(p)


def list_dirs(path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _resolve(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.NotFound:
        return []
    sel = pafs.FileSelector(p, recursive=False)
    return sorted(i.base_name for i in fs.get_file_info(sel) if i.type == pafs.FileType.Directory)


def list_files(path: str) -> list[str]:
    """Names of the files in ``path`` (empty if it does not exist)."""
    fs, p = _resolve(path)
    if fs.get_file_info(p).type == pafs.FileType.NotFound:
        return []
    sel = pafs.FileSelector(p, recursive=False)
    return sorted(i.base_name for i in fs.get_file_info(sel) if i.type == pafs.FileType.File)


def remove_dir(path: str) -> None:
    fs, p = _resolve(path)
    fs.delete_dir(p)


def exists(path: str) -> bool:
    fs, p = _resolve(path)
    return fs.get_file_info(p).type != pafs.FileType.NotFound


def move(src: str, dst: str) -> None:
    """Replace ``dst`` by ``src`` (a rename where the store has one)."""
    fs, s = _resolve(src)
    _, d = _resolve(dst)
    fs.move(s, d)
