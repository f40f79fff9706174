"""Binary files that tasks write and read in shared storage.

Spark's writers have no raw bytes, so tasks open files through Arrow's file systems, by addresses that are made
complete on the driver. A task gives its file a name of its own and returns
that name as a row; what the stored rows name counts, and what a lost or repeated task left besides is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession


#: Schemes of addresses that Arrow opens, and those that it knows by another name.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")
_RENAMED = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder's full address, the same place for Spark and for Arrow on every executor.

    An address without a scheme is one of the session's default file system, which Arrow would take for a local one.
    Raises ValueError for a scheme that Arrow does not know.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if path.toUri().getScheme() is None:
        path = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path)
    scheme, rest = path.toString().split(":", 1)
    scheme = _RENAMED.get(scheme, scheme)
    if scheme not in SCHEMES:
        raise ValueError(f"binary files cannot be written to {folder}: no file system for {scheme}")
    return f"{scheme}:{rest}" if rest.startswith("//") else f"{scheme}://{rest}"


def new_file(folder: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """An address that no other attempt has, and the file opened for writing."""
    address = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = fs.FileSystem.from_uri(address)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return address, system.open_output_stream(path, compression=None)  # not by the suffix


def open_stream(address: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_stream(path, compression=None)


def open_random(address: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def chunks(stream: pa.NativeFile, size: int = 1 << 18) -> Iterator[bytes]:
    while chunk := stream.read(size):
        yield chunk
