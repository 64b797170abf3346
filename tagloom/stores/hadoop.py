"""Small file-system steps on any Hadoop-compatible storage, done on the driver."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


class FileSystem:
    """The few calls the stores need. Carries names and markers only, never table data."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(folder)))

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Write a new file; fails if another writer made it first.

        The text is written aside and renamed, so the file is there with all of it or not
        at all. This needs a storage whose rename is atomic, such as HDFS or a local disk.
        """
        jvm, target = self._spark._jvm, self._path(path)
        aside = self._path(f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")
        self._fs.mkdirs(target.getParent())
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        no_overwrite = self._spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._fs.makeQualified(aside), self._fs.makeQualified(target), no_overwrite)
        except Exception:
            self._fs.delete(aside, False)
            raise

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, source: str, target: str) -> bool:
        return self._fs.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def delete_on_exit(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # In local-cluster mode executors are processes of their own.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return os.path.join(tempfile.gettempdir(), "tagloom-checkpoints")


_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders made inside go at the end, on error as well. No frame that reads
    them may be used after that."""
    token = _SCOPE.set(scratch_folder(spark))
    try:
        yield
    finally:
        delete_folder(spark, _SCOPE.get())
        _SCOPE.reset(token)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder inside the shared one, or the current scope, deleted when the session's
    JVM ends."""
    folder = f"{_SCOPE.get() or shared_folder(spark)}/tagloom-{uuid.uuid4().hex}"
    fs = FileSystem(spark, folder)
    fs.make_folder(folder)
    fs.delete_on_exit(folder)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    FileSystem(spark, folder).delete(folder)


def written(frame: DataFrame, folder: str, **options: str) -> DataFrame:
    """The frame as a table in ``folder``, which cuts its lineage: later reads recompute
    nothing, and lost executors lose none of it."""
    path = f"{folder}/{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
