"""Files and folders of a store, as tasks reach them."""

from __future__ import annotations

from pyarrow import fs


def system_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    for hadoop_name in ("s3a://", "s3n://"):
        if path.startswith(hadoop_name):
            path = "s3://" + path[len(hadoop_name) :]
    return fs.FileSystem.from_uri(path)


def files_below(folder: str) -> list[tuple[str, int]]:
    """(path relative to the folder, length) of every visible Parquet file, at any depth."""
    system, inner = system_of(folder)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=True))
    inner = inner.rstrip("/")
    out = []
    for info in found:
        name = info.path[len(inner) :].lstrip("/")
        hidden = any(part[:1] in "._" for part in name.split("/"))
        if info.is_file and name.endswith(".parquet") and not hidden:
            out.append((name, info.size))
    return sorted(out)
