"""Byte ranges of files that tasks read and write, in whatever file system their URI names."""

from __future__ import annotations

from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs

#: Schemes as Hadoop names them, and as Arrow does.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def system_of(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a local path; schemes that Arrow does not know go to an installed fsspec package."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    scheme = urlsplit(uri).scheme
    uri = _SCHEMES.get(scheme, scheme) + uri[len(scheme) :]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    try:
        return fs.FileSystem.from_uri(uri)
    except (ValueError, NotImplementedError, pa.ArrowInvalid) as error:
        try:
            import fsspec
        except ImportError:
            raise ValueError(f"no file system for {uri}: install the fsspec package of its scheme") from error
        system, path = fsspec.core.url_to_fs(uri)
        return fs.PyFileSystem(fs.FSSpecHandler(system)), path


def files(uri: str, ending: str) -> list[tuple[str, int]]:
    """(URI, size) of a file, or of a folder's files with this ending, by name."""
    system, path = system_of(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    if info.type == fs.FileType.File:
        return [(uri, info.size)]
    found = system.get_file_info(fs.FileSelector(path))
    return sorted((f"{uri.rstrip('/')}/{f.base_name}", f.size) for f in found if f.type == fs.FileType.File and f.base_name.endswith(ending))


class Ranges:
    """A file open for reading byte ranges; counts them."""

    def __init__(self, uri: str):
        system, path = system_of(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()
        self.reads = 0

    def read(self, offset: int, length: int) -> bytes:
        self.reads += 1
        return self.file.read_at(max(0, min(length, self.size - offset)), offset)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def put(uri: str, blob: bytes) -> None:
    system, path = system_of(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(blob)
