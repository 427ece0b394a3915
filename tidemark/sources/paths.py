"""Folder operations through Hadoop's FileSystem, so the same code works on
local disk, HDFS or object stores. Used only for publish / discard steps;
all data moves through Spark's readers and writers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def delete_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder if nothing is in it."""
    p, fs = _fs(spark, path)
    if fs.exists(p) and not len(fs.listStatus(p)):
        fs.delete(p, False)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    s, fs = _fs(spark, src)
    d, _ = _fs(spark, dst)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise OSError(f"could not move {src} to {dst}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when the folder holds at least one non-hidden file."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith((".", "_")):
            return True
    return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file: write a sibling, then rename it over."""
    import uuid
    p, fs = _fs(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise OSError(f"could not publish {path}")


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file only if there is none of that name; False if
    there is. The file appears whole or not at all: it is written under a
    name of its own and renamed without overwriting, which HDFS and most
    object-store connectors do as one step. (A local disk checks and renames in two.)"""
    import uuid

    from py4j.protocol import Py4JJavaError
    hadoop = spark._jvm.org.apache.hadoop.fs
    p, fs = _fs(spark, path)
    p = fs.makeQualified(p)
    if fs.exists(p):
        return False
    tmp = hadoop.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(tmp, p, no_overwrite)
        return True
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" not in exc.java_exception.getClass().getName():
            raise
        return False
    finally:
        if fs.exists(tmp):
            fs.delete(tmp, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, or None when it does not exist."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly inside a folder, sorted."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())
