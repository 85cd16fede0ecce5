"""Bounded reads of landed files inside tasks: first lines and digests.

Files are opened by the tasks through Arrow's file systems (local, S3, GCS,
HDFS, ...), never by the driver and never as one row, so the memory of a read
does not grow with the file. ``reachable`` tells whether Arrow can open a
store; callers fall back to a Spark source where it cannot.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 20
FIRST = 1 << 16
#: Longest first line that is accepted.
MAX_LINE = 1 << 24


def locate(path: str):
    """(file system, path in it) of a path as Spark's file listing gives it."""
    from pyarrow import fs

    scheme, authority, rest = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(/?.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), rest
    store, base = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority or ''}/")
    return store, base.rstrip("/") + rest


def reachable(path: str) -> bool:
    """Whether Arrow can open the store of ``path``."""
    from pyarrow import fs

    try:
        store, inner = locate(path)
        return store.get_file_info(inner).type != fs.FileType.NotFound
    except (ImportError, OSError, ValueError, NotImplementedError, pa.ArrowException):
        return False


def first_line(stream) -> bytes:
    """The first line of an open stream, read block by block."""
    got = b""
    while b"\n" not in got:
        block = stream.read(FIRST)
        if not block:
            break
        got += bytes(block)
        if len(got) > MAX_LINE:
            raise ValueError(f"no line end within the first {MAX_LINE} bytes")
    return got.split(b"\n", 1)[0].removesuffix(b"\r").removeprefix(b"\xef\xbb\xbf")


def sha256(stream) -> str:
    digest = hashlib.sha256()
    while block := stream.read(CHUNK):
        digest.update(block)
    return digest.hexdigest()


def _each(files: DataFrame, column: str, read: Callable) -> DataFrame:
    """``files`` (path, ...) with what ``read`` gives for each open file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                store, inner = locate(path)
                with store.open_input_stream(inner) as stream:
                    out.append(read(stream))
            yield batch.append_column(column, pa.array(out, pa.string()))

    schema = ", ".join(f"`{n}` {t}" for n, t in files.dtypes)
    return files.mapInArrow(run, f"{schema}, `{column}` string")


def first_lines(files: DataFrame) -> DataFrame:
    """``files`` with ``header``, the first line; reads 64 KiB of a file
    unless its first line is longer."""
    return _each(files, "header", lambda s: first_line(s).decode("utf-8", "replace"))


def digests(files: DataFrame) -> DataFrame:
    """``files`` with ``sha256``, read in 1 MiB blocks."""
    return _each(files, "sha256", sha256)
