"""What loops need from the session: a shared folder and kept inputs."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, also set as the checkpoint folder.

    On a local master without that setting a temporary folder is used, so tests
    run unconfigured.  On a cluster a missing setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="colfit-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


PACKAGE = "colfit-package.zip"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run on executors are pickled by module name, so the workers must
    be able to import the package whatever their folder and path.
    """
    context = spark.sparkContext
    if any(f.endswith(PACKAGE) for f in context.listFiles):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="colfit-"), PACKAGE)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Kept in memory and on disk within the block; lost blocks are recomputed."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
