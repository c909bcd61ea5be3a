"""Files and folders through the Hadoop file system API: whatever store the session can reach."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path in it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.getFileStatus(p).isDirectory())


def qualified(spark: SparkSession, path: str) -> str:
    """Full name of a file with its scheme, encoded as Spark shows it in ``_metadata.file_path``."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toUri().toString()


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = hadoop_path(spark, src)
    _, q = hadoop_path(spark, dst)
    if not fs.rename(p, q):
        raise OSError(f"rename failed: {src} -> {dst}")


def file_versions(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the names, sizes and modification times of the files under ``paths``: another one if any changes."""
    found = []
    for path in paths:
        fs, p = hadoop_path(spark, path)
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:16]


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.getFileStatus(p).isDirectory())


def qualified(spark: SparkSession, path: str) -> str:
    """Full name of a file with its scheme, encoded as Spark shows it in ``_metadata.file_path``."""
    fs, p = hadoop_path(spark, path)
    return fs.makeQualified(p).toUri().toString()


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = hadoop_path(spark, src)
    _, q = hadoop_path(spark, dst)
    if not fs.rename(p, q):
        raise OSError(f"rename failed: {src} -> {dst}")


def modification_time(spark: SparkSession, path: str) -> int:
    """Modification time (ms) of a file or folder, through the Hadoop file system API."""
    fs, p = hadoop_path(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p)


def entries(spark: SparkSession, path: str) -> dict[str, int]:
    """Visible names directly under a folder (files or partitions) with their sizes, from one listing."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return {}
    found = {s.getPath().getName(): int(s.getLen()) for s in fs.listStatus(p)}
    return {n: size for n, size in found.items() if not n.startswith(("_", "."))}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path, from the store's own summary (one call); 0 where there is nothing."""
    fs, p = hadoop_path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole."""
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
