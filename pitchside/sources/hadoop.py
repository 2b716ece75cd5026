"""Small file operations through Hadoop's file system API (HDFS, S3, ABFS, local alike).

Metadata only: a listing, a marker or a manifest of a few kilobytes. Data goes through
Spark's readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none if it does not exist."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path below ``path``, bytes, modification time) of all files under it, sorted."""
    p, fs = _path(spark, path)
    root = fs.resolvePath(p).toUri().getPath().rstrip("/")
    out, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        s = walk.next()
        out.append((s.getPath().toUri().getPath().removeprefix(root).lstrip("/"), s.getLen(), s.getModificationTime()))
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, or return False if ``path`` is there already.

    The text goes to a file of another name, which is then renamed without overwriting:
    readers see all of it or nothing, and of two writers one is refused. That is atomic
    where renames are (HDFS, ABFS, local disks); a plain object store only checks first."""
    sc = spark.sparkContext
    target, fs = _path(spark, path)
    draft = sc._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    no_options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), no_options)
    except Exception:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)
