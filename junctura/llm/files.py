"""Binary files in the shared folder, written and read inside tasks through whatever file system the folder's URI names."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs

#: Schemes as Hadoop names them, and as Arrow does.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def system_of(uri: str):
    """File system and path of a URI: Arrow's own, or one that an installed fsspec package has."""
    scheme = urlsplit(uri).scheme
    if scheme in _SCHEMES:
        uri = _SCHEMES[scheme] + uri[len(scheme) :]
    try:
        return fs.FileSystem.from_uri(uri)
    except (ValueError, NotImplementedError, pa.ArrowInvalid) as error:
        try:
            import fsspec
        except ImportError:
            raise ValueError(f"no file system for {uri}: install the fsspec package of its scheme") from error
        system, path = fsspec.core.url_to_fs(uri)
        return fs.PyFileSystem(fs.FSSpecHandler(system)), path


def open_dir(uri: str):
    """File system and path of a folder; creates it."""
    system, path = system_of(uri)
    system.create_dir(path, recursive=True)
    return system, path


def fresh(uri: str, ending: str):
    """A new file for one task attempt: (file system, its path, its URI).  Only finished attempts' names reach an index."""
    system, path = open_dir(uri)
    name = f"{uuid.uuid4().hex}{ending}"
    return system, f"{path}/{name}", f"{uri}/{name}"


def read(uri: str, offset: int | None = None, length: int | None = None) -> bytes:
    system, path = system_of(uri)
    with system.open_input_file(path) as f:
        return f.read() if offset is None else f.read_at(length, offset)
