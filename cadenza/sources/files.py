"""Files in any store that Arrow opens (local, HDFS, S3, GCS), by path or URI: listing, parts of files, and moves.

Data sources plan and read through these, so that a task opens its own part of a file and no more.
"""

from __future__ import annotations

import fnmatch

from pyarrow import fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, pattern: str = "*") -> list[tuple[str, int]]:
    """(path, bytes) of the files at or below a path, by name. Hidden files and those of unfinished jobs are left out."""
    system, at = store(path)
    info = system.get_file_info(at)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(at, recursive=True))
    names = [(f.path, f.size) for f in found if f.is_file and fnmatch.fnmatch(f.base_name, pattern) and not any(p.startswith(("_", ".")) for p in f.path[len(at) :].split("/"))]
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    return sorted((prefix + p, n) for p, n in names)
