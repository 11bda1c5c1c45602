"""Small files through Hadoop's file systems: listing, reading, and writing that never replaces.

``put_if_absent`` is what run ids and commits stand on: of several writers of one name exactly one
succeeds, and a reader sees the whole content or no file.  The content goes to a name of its own first and
gets the final name in one step that fails where the name is taken: a hard link on a local file
system, a rename on others (atomic on HDFS; an object store needs a connector with atomic renames).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``, sorted; none if it does not exist.  Hidden ones are left out."""
    fs, p = _open(spark, folder)
    if not fs.exists(p):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(n for n in found if not n.startswith("."))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``path`` unless it exists; whether this call wrote it."""
    fs, p = _open(spark, path)
    fs.mkdirs(p.getParent())
    held = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(held, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(held.toUri().getPath(), p.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not fs.exists(p) and fs.rename(held, p)
    finally:
        fs.delete(held, False)
