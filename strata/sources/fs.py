"""Files on any file system that Spark's session reaches.

Everything goes through the Hadoop file system of the path, so ``hdfs://``, object stores and local folders behave
alike. A rename moves names, not data, on file systems with real folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """(file system, path) handles of the session's Hadoop configuration."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly under ``path`` (hidden ones start with ``_`` or ``.``)."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "_.")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced if it is there."""
    fs, handle = _open(spark, path)
    out = fs.create(handle, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, without a Spark job."""
    fs, handle = _open(spark, path)
    source = fs.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.delete(handle, True)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle) and fs.getFileStatus(handle).isFile()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``, sorted."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isFile())


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small text file under a name that must be free; False if it is taken."""
    fs, handle = _open(spark, path)
    try:
        out = fs.create(handle, False)
    except Exception as exc:
        if fs.exists(handle):
            return False
        raise exc
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put ``staged`` in the place of ``path`` by renaming. What was there is moved aside first, moved back if the
    rename fails, and removed after it."""
    fs, handle = _open(spark, path)
    _, new = _open(spark, staged)
    fs.mkdirs(handle.getParent())
    _, aside = _open(spark, f"{staged.rstrip('/')}.replaced-{uuid.uuid4().hex[:8]}")
    had = fs.exists(handle)
    if had and not fs.rename(handle, aside):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, handle):
        if had:
            fs.rename(aside, handle)
        raise OSError(f"cannot rename {staged} to {path}")
    if had:
        fs.delete(aside, True)
