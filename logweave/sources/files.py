"""Files of the shared folder as Spark's Python data sources see them: from the
planning process and from tasks, which have no session."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it (``/x``, ``file:/x``,
    ``hdfs://host/x``, ``s3://bucket/x``) and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def names(system: fs.FileSystem, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found)


def exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


def text_of(system: fs.FileSystem, path: str) -> str:
    with system.open_input_stream(path) as stream:
        return stream.read().decode()
