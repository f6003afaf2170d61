"""Small file-system calls through the session's Hadoop FileSystem (local, HDFS, object stores).

Only metadata and small text files pass through here; data is always read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """(path, is it a folder) of all that match ``pattern`` (Hadoop glob syntax), sorted; hidden names
    (``_``, ``.``) are left out unless the pattern asks for them. Empty when none match."""
    fs, jpath = locate(spark, pattern)
    hidden = jpath.getName()[:1] in ("_", ".")
    found = [(s.getPath().toString(), s.isDirectory()) for s in fs.globStatus(jpath) or []]
    return sorted(f for f in found if hidden or f[0].rpartition("/")[2][:1] not in ("_", "."))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, as listings give it."""
    fs, jpath = locate(spark, path)
    return fs.makeQualified(jpath).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = locate(spark, path)
    return bool(fs.exists(jpath))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, jpath = locate(spark, path)
    return bool(fs.delete(jpath, recursive))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = locate(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(jpath))


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or folder to a path that does not exist; folders above it are made."""
    fs, jpath = locate(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(jpath, target):
        raise OSError(f"{path} could not be moved to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 text file."""
    fs, jpath = locate(spark, path)
    source = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small UTF-8 text file (QC reports), replacing any previous one."""
    fs, jpath = locate(spark, path)
    parent = jpath.getParent()
    if parent is not None:
        fs.mkdirs(parent)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
