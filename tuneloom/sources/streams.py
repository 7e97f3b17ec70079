"""Files opened inside tasks, where the JVM's file systems are out of reach."""

from __future__ import annotations

from typing import BinaryIO, Callable

#: Names of a store in Hadoop and in Arrow.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}

Opener = Callable[[str], BinaryIO]


def _located(path: str):
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":  # Spark's local paths are not escaped
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


def open_path(path: str) -> BinaryIO:
    """A file of any store that Arrow knows, opened for reading from any place
    in it; nothing but what is read is held."""
    store, inside = _located(path)
    return store.open_input_file(inside)


def reachable(path: str) -> bool:
    """Whether Arrow knows the store of a path and can reach it from here."""
    try:
        _located(path)
    except (OSError, ValueError):
        return False
    return True
