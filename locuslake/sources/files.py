"""Files that tasks open by themselves: local and shared folders, and stores that Arrow knows (s3, gs, hdfs)."""

from __future__ import annotations

import posixpath
import re

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path within it); Spark's file:/a is file:///a."""
    local = re.match(r"^file:/+", path)
    if local:
        return fs.LocalFileSystem(), "/" + path[local.end() :]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, suffix: str) -> list[str]:
    """The path itself, or of a folder the files below it that end so, in order; with the scheme of `path`."""
    system, inner = opened(path)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    found = sorted(f.path for f in system.get_file_info(fs.FileSelector(inner, recursive=True)) if f.is_file and f.path.endswith(suffix))
    return [path.rstrip("/") + f[len(inner.rstrip("/")) :] for f in found]


def put(path: str, pieces) -> int:
    """Write pieces of bytes as a file that is there whole or not at all: a task that is run again replaces it. Its size."""
    system, inner = opened(path)
    system.create_dir(posixpath.dirname(inner), recursive=True)
    size = 0
    with system.open_output_stream(inner + ".part") as out:
        for piece in pieces:
            out.write(piece)
            size += len(piece)
    system.move(inner + ".part", inner)
    return size
