"""Folders and whole files, through Spark's own file systems, so that any store will do."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Entry(NamedTuple):
    name: str
    path: str
    is_folder: bool
    size: int


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, without a slash at its end."""
    place, store = _opened(spark, path)
    return store.makeQualified(place).toString()


def listed(spark: SparkSession, folder: str) -> list[Entry]:
    """What a folder holds, by name; nothing if there is no such folder."""
    place, store = _opened(spark, folder)
    if not store.exists(place) or not store.getFileStatus(place).isDirectory():
        return []
    found = [Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getLen()) for s in store.listStatus(place)]
    return sorted(found)


def is_empty_or_invalid(spark: SparkSession, path: str) -> bool:
    """Whether a delimited file is missing, has no bytes, begins with a blank line or cannot be read as text."""
    place, store = _opened(spark, path)
    if not store.exists(place) or not store.getFileStatus(place).getLen():
        return True
    try:
        first = spark.read.text(path).limit(1).collect()
    except Exception:  # noqa: BLE001  whatever cannot be read is invalid
        return True
    return not first or not first[0][0].strip()


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, size, sha256) of whole files; the tasks read them, none may be larger than 2 GB."""
    rows = spark.read.format("binaryFile").load(paths)
    return rows.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def joint_digest(spark: SparkSession, paths: list[str]) -> str:
    """SHA-256 of the files' names and digests, by name; of no files the digest of nothing."""
    rows = file_digests(spark, paths).select("path", "sha256").collect() if paths else []
    return hashlib.sha256("".join(f"{p.rsplit('/', 1)[-1]}:{d}\n" for p, d in sorted((r[0], r[1]) for r in rows)).encode()).hexdigest()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of UTF-8 text."""
    place, store = _opened(spark, path)
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    place, store = _opened(spark, path)
    stream = store.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of an older one."""
    remove(spark, path)
    create_text(spark, path, text)


def remove(spark: SparkSession, path: str) -> None:
    place, store = _opened(spark, path)
    store.delete(place, True)


def resolved(spark: SparkSession, path: str) -> str:
    """The place that a path leads to, with symbolic links followed where the store has them."""
    place, store = _opened(spark, path)
    found = store.makeQualified(place).toString()
    if found.startswith("file:"):
        local = spark._jvm.java.io.File(spark._jvm.java.net.URI(found).getPath()).getCanonicalPath()
        return store.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(local)).toString()
    return found
