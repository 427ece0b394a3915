"""Code and small files for Python workers, handed out by Spark."""

from __future__ import annotations

import hashlib
import io
import os
import zipfile

from pyspark.sql import SparkSession

from ..session import work_root
from ..sources.paths import _fs

_SENT: set[tuple[str, str]] = set()


def _put(spark: SparkSession, name: str, content: bytes) -> str:
    """Writes a small file into the shared folder unless it is there; the name
    carries a hash of the content."""
    path = f"{work_root(spark)}/tidemark/files/{name}"
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        tmp, _ = _fs(spark, f"{path}.{os.getpid()}")
        out = fs.create(tmp, True)
        try:
            for at in range(0, len(content), 1 << 20):
                out.write(content[at:at + (1 << 20)])
        finally:
            out.close()
        if not fs.rename(tmp, p) and not fs.exists(p):
            raise OSError(f"could not publish {path}")
    return path


def send_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Hands a small file to all executors, later ones included, through the
    shared folder; returns the name that ``SparkFiles.get`` takes there."""
    stem, dot, ext = name.rpartition(".")
    full = f"{stem}-{hashlib.sha256(content).hexdigest()[:16]}{dot}{ext}"
    key = (spark.sparkContext.applicationId, full)
    if key not in _SENT:
        spark.sparkContext.addFile(_put(spark, full, content))
        _SENT.add(key)
    return full


def send_code(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, wherever the driver
    found it. Does nothing where it already came from a package archive."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(root):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    info = zipfile.ZipInfo(os.path.relpath(full, os.path.dirname(root)))
                    with open(full, "rb") as f:
                        z.writestr(info, f.read())
    content = buffer.getvalue()
    key = (spark.sparkContext.applicationId, hashlib.sha256(content).hexdigest())
    if key not in _SENT:
        spark.sparkContext.addPyFile(_put(spark, f"{os.path.basename(root)}-{key[1][:16]}.zip", content))
        _SENT.add(key)
