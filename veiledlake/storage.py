"""Shared folders: the work folder of a session, and small files next to tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's checkpoint directory.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="veiledlake-")
        spark.sparkContext.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/veiledlake-{uuid.uuid4().hex}"
    fs, target = _locate(spark, folder)
    fs.deleteOnExit(target)  # what is left in it, perhaps in clear, goes with the session
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A work folder that is deleted afterwards: it may hold values in clear."""
    folder = work_folder(spark)
    try:
        yield folder
    finally:
        delete(spark, folder)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _locate(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def newest(spark: SparkSession, folder: str) -> int:
    """Change time in milliseconds of the newest file in a folder, 0 if there is none."""
    fs, target = _locate(spark, folder)
    if not fs.exists(target):
        return 0
    return max((s.getModificationTime() for s in fs.listStatus(target) if s.isFile()), default=0)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _locate(spark, path)
    stream = fs.open(target)
    try:
        size = fs.getFileStatus(target).getLen()
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it must not exist yet.

    The file gets its final name only when complete, so readers never see half of it.
    """
    fs, target = _locate(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        raise FileExistsError(path)


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there; of several writers at once one succeeds.

    On a local disk and on HDFS creation is atomic. On a store where it is not, the
    writers read back who was last, which leaves one as well.
    """
    fs, target = _locate(spark, path)
    fs.mkdirs(target.getParent())
    try:
        if fs.getScheme() == "file":
            local = spark._jvm.java.io.File(target.toUri().getPath())
            if not local.createNewFile():
                return False
            stream = fs.create(target, True)
        else:
            stream = fs.create(target, False)
    except Exception as error:
        if fs.exists(target):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return read_text(spark, path) == text


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
