"""Folders and small files on whatever file system a path names, through Hadoop's own interface."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).mkdirs(_path(spark, path))


def delete_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    system = _system(spark, path)
    if not system.exists(_path(spark, path)):
        return None
    stream = system.open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it does not exist."""
    system = _system(spark, path)
    if not system.exists(_path(spark, path)):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(_path(spark, path)) if status.isDirectory())


def _put(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    """Write beside the path, then rename: a reader sees the whole text or none of it."""
    system, new = _system(spark, path), _path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(new.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE if overwrite else hadoop.Options.Rename.NONE
    try:
        context.rename(new, _path(spark, path), options)
    except Exception:
        system.delete(new, False)
        raise


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file where there is none; False if there is one already, which stays as it is."""
    try:
        _put(spark, path, text, overwrite=False)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of another in one step: a reader sees the old text or the new one."""
    _put(spark, path, text, overwrite=True)
