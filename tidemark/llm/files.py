"""Files that tasks write and read themselves under the shared folder."""

from __future__ import annotations

from pyarrow import fs


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri
