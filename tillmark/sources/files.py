"""Small file helpers.

``first_line`` and ``copy_file`` run inside tasks, next to the data, on paths with a scheme.
The others run on the driver and see one folder each.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import SparkSession


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path as Spark writes it, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{quote(rest)}")


def first_line(path: str) -> str:
    """First line of a text file; reads no more of it than that takes."""
    store, name = open_store(path)
    head = b""
    with store.open_input_stream(name) as stream:
        while b"\n" not in head:
            chunk = stream.read(1 << 16)
            if not chunk:
                break
            head += chunk
    return head.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")


def copy_file(source: str, target: str) -> int:
    """Copy byte by byte and return the size. The target appears whole or not at all, so a
    second attempt of the same task does no harm."""
    source_store, source_name = open_store(source)
    target_store, target_name = open_store(target)
    target_store.create_dir(target_name.rsplit("/", 1)[0], recursive=True)
    unfinished = f"{target_name}.{uuid.uuid4().hex}.part"
    size = 0
    with (
        source_store.open_input_stream(source_name, compression=None) as reader,
        target_store.open_output_stream(unfinished, compression=None) as writer,
    ):
        while chunk := reader.read(1 << 22):
            size += len(chunk)
            writer.write(chunk)
    target_store.move(unfinished, target_name)
    return size


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system spelled out, so that tasks need not know the default one."""
    store, place = _spark_store(spark, path)
    return store.makeQualified(place).toString()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if the path does not exist."""
    store, place = _spark_store(spark, path)
    found = store.listStatus(place) if store.exists(place) else []
    return [entry.getPath().getName() for entry in found if entry.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _spark_store(spark, path)
    return store.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    store, place = _spark_store(spark, path)
    store.delete(place, True)


def _spark_store(spark: SparkSession, path: str):
    """The file system Spark itself uses for a path, with its settings and credentials."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
