"""Bytes of files, read as streams by tasks: starts of files and digests of whole ones.

Spark lists the files without opening them; the rows of that list are spread over tasks, and a
task opens each of its files through the file system its address names. Memory is one chunk, however
long a file is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes read at once from a file that is digested, and first from one whose start is wanted.
CHUNK = 4 << 20
FIRST = 16 << 10

#: Addresses that Spark and Python file systems name differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _resolved(address: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = address.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), (rest if colon else address).replace("///", "/", 1)
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def open_stream(address: str) -> BinaryIO:
    """A file as a stream of bytes."""
    system, path = _resolved(address)
    return system.open_input_stream(path, compression=None)


def can_open(address: str) -> bool:
    """Whether Python has a file system for the address; nothing is opened."""
    try:
        _resolved(address)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, n_bytes) of all files that match; their contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("n_bytes"))


def digest(address: str) -> str:
    """MD5 of a file in memory of one chunk."""
    made = hashlib.md5(usedforsecurity=False)
    with open_stream(address) as stream:
        while chunk := stream.read(CHUNK):
            made.update(chunk)
    return made.hexdigest()


def first_record(address: str, encoding: str) -> str | None:
    """The first line of a file that is not blank, with the line breaks within its quotes; None if there is none.

    Reads on only as long as that line does not end.
    """
    data, size = b"", FIRST
    with open_stream(address) as stream:
        while True:
            chunk = stream.read(size)
            data += chunk
            text = data.decode(encoding, errors="ignore").lstrip("﻿").lstrip("\r\n")
            end = -1
            while (end := text.find("\n", end + 1)) >= 0:
                if text.count('"', 0, end) % 2 == 0:
                    return text[:end].rstrip("\r")
            if not chunk:
                return text.rstrip("\r") or None
            size *= 2


def _each(column: str, kind: str, make: Callable[[str], object], files: DataFrame) -> DataFrame:
    """The listed files with what is made of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(address) for address in batch.column(1).to_pylist()]
            columns = [batch.column(0), batch.column(2), pa.array(made, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "n_bytes", column])

    return files.mapInArrow(run, f"file string, n_bytes bigint, {column} {kind}")


def digests(files: DataFrame) -> DataFrame:
    """(file, n_bytes, file_hash): a file of any size is one row, read as a stream by one task."""
    return _each("file_hash", "string", digest, files)


def first_records(files: DataFrame, encoding: str) -> DataFrame:
    """(file, n_bytes, header): what is read of a file does not grow with it."""
    return _each("header", "string", lambda address: first_record(address, encoding), files)
