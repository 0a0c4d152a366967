"""Publishing a file under a name that only one writer can have."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from tidemark.functions.crash import barrier

#: Stores where a file appears whole when it is closed, and creating without overwriting is a conditional put.
OBJECT_STORES = ("s3a", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn")


def filesystem(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write(fs, path, content: bytes, overwrite: bool) -> None:
    out = fs.create(path, overwrite)
    out.write(bytearray(content))
    out.close()


def publish(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a file whole, or raises FileExistsError where the name is taken; of two writers one succeeds.

    A local file is linked to its name, which fails where the name exists; object stores get a conditional put; other
    file systems (HDFS) rename a finished file, which they refuse where the target exists.
    """
    fs, final = filesystem(spark, path)
    scheme = fs.getUri().getScheme()
    barrier("before_close_marker")
    if scheme in OBJECT_STORES:
        try:
            _write(fs, final, content, False)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "PreconditionFailed" in str(e):
                raise FileExistsError(path) from e
            raise
        return
    temporary = spark._jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    _write(fs, temporary, content, True)
    try:
        if scheme == "file":
            local = lambda p: unquote(urlparse(p.toUri().toString()).path)
            os.link(local(temporary), local(final))
        elif not fs.rename(temporary, final):
            raise FileExistsError(path)
    finally:
        fs.delete(temporary, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None where it doesn't exist."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return None
    stream, out = fs.open(p), spark._jvm.java.io.ByteArrayOutputStream()
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 65536, True)
    return bytes(out.toByteArray()).decode()


def names(spark: SparkSession, folder: str, suffix: str = ".json") -> list[str]:
    """Names in a folder that end with suffix, sorted; hidden ones are left out."""
    fs, p = filesystem(spark, folder)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if n.endswith(suffix) and n[0] not in "._")
