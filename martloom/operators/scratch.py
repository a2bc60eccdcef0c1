"""Fresh folders in the storage shared by driver and executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from martloom.operators.files import delete_folder

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local session, whose driver and executors are one process, may go without the setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.gettempdir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    folder = f"{shared_folder(spark)}/martloom/{purpose}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(folder)
    return folder


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Deletes the fresh folders named inside the block when it ends, also by an error.

    For work whose result is stored elsewhere within the block: a result that is only composed still needs its folders.
    Folders named by other threads, or in other blocks, are left alone.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in made:
            delete_folder(spark, folder)
