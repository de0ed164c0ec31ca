"""Small control files beside data, through Hadoop's file-system API (any store Spark writes to), and files in tasks."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def in_task(path: str):
    """A path as Spark writes it, as pyarrow's file system and the name there; needs no JVM, so tasks may use it."""
    import re

    from pyarrow import fs
    scheme, authority, rest = re.match(r"(?:([a-z0-9]+):)?(?://([^/]*))?(.*)", path, re.S).groups()
    store, base = fs.FileSystem.from_uri(f"{scheme or 'file'}://{authority or ''}/")
    return store, base.rstrip("/") + rest


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below ``folder``, sorted; none if it does not exist."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def scheme(spark: SparkSession, path: str) -> str:
    return _path(spark, path)[1].getUri().getScheme()


def states(spark: SparkSession, folder: str, key: str) -> dict[str, str]:
    """Per ``key=value`` folder below ``folder``: a digest of its files' names, sizes and times."""
    p, fs = _path(spark, folder)
    found: dict[str, list[str]] = {}
    each = fs.listFiles(p, True) if fs.exists(p) else None
    while each is not None and each.hasNext():
        f = each.next()
        parts = [x for x in f.getPath().toString().split("/") if x.startswith(f"{key}=")]
        if parts and not f.getPath().getName().startswith(("_", ".")):
            found.setdefault(parts[-1].split("=", 1)[1], []).append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}")
    return {k: hashlib.sha1("\n".join(sorted(v)).encode()).hexdigest() for k, v in found.items()}


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet: whole under another name, then renamed without overwriting."""
    jvm = spark.sparkContext._jvm
    temporary, name = path.rsplit("/", 1)
    temporary = f"{temporary}/.{name}.{uuid.uuid4().hex[:8]}"
    p, fs = _path(spark, temporary)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), none)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that a table owns."""
    p, fs = _path(spark, path)
    fs.delete(p, True)
