"""Questions to the file system that must not be answered by a failed read."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def beside(path: str, kind: str) -> str:
    """``_<kind>_<name>`` in the folder that holds ``path``."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{kind}_{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names of the visible entries (with ``hidden`` of all) directly under ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = (x.getName() for x in spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p)))
    return [n for n in names if hidden or n[0] not in "._"]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything has been written at ``path``. Errors of the file system are raised, never read as "no".

    A folder that holds nothing but what an unfinished write left behind is an
    error too: taking it for "no table" would build one from part of its rows.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    entries, unfinished = fs.listStatusIterator(p), False  # stops at the first visible one
    while entries.hasNext():
        name = entries.next().getPath().getName()
        if name == "_delta_log" or name[0] not in "._":
            return True
        unfinished |= name == "_temporary"
    if unfinished:
        raise RuntimeError(f"{path} holds only the leftovers of an unfinished write: restore the table or remove the folder")
    return False


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; whatever stands at ``target`` goes first, folders above it are made."""
    fs, src = _fs(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(dst):
        fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {source} to {target}")


def renames_at_once(spark: SparkSession, path: str) -> bool:
    """Whether folders of this file system are renamed in one step (object stores copy them file by file)."""
    fs, _ = _fs(spark, path)
    return fs.getScheme() in ("file", "hdfs", "viewfs", "abfs", "abfss")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place whole or not at all: written under another name, then renamed."""
    fs, _ = _fs(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}"
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(beside), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, beside, path)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file unless there is one; whether it was made. Of several contenders one makes it."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates later
        try:
            with open(p.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True
