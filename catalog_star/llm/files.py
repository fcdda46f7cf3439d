"""Files that tasks write or read by themselves, in any store that pyarrow's file systems reach."""

from __future__ import annotations

from pyarrow import fs


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder.rstrip("/")
    if folder.startswith("file:") and "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    store, path = fs.FileSystem.from_uri(folder)
    return store, path.rstrip("/")


def exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound
