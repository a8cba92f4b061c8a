"""Small files and renames in any file system that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system, system.makeQualified(where)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system."""
    return _at(spark, path)[1].toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if it is not there."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    # a local file system renames a file and its checksum one after the other
    system.setVerifyChecksum(False)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
        system.setVerifyChecksum(True)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: others see the old one or the new one, never a part."""
    folder, _, name = path.rstrip("/").rpartition("/")
    system, waiting = _at(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    out = system.create(waiting, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target = _at(spark, path)[1]
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(waiting, target, how)
