"""Where a run may write what several executors must see."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` or the context's, else one in the warehouse.

    The warehouse is the other place that all executors reach, whatever file system it is on.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.windrow"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for one run's tables."""
    return f"{shared_folder(spark).rstrip('/')}/windrow/{name}-{uuid.uuid4().hex}"


def arrow_files(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path of Spark's, and the path there, for reading and writing in Python tasks."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parsed.path)
    return pafs.FileSystem.from_uri(uri)


def tasks_reach(folder: str) -> bool:
    """Python can read and write in the folder, not only Spark; only the driver tries."""
    try:
        files, path = arrow_files(folder)
        files.create_dir(path, recursive=True)
        return files.get_file_info(path).type == pafs.FileType.Directory
    except (OSError, ValueError, NotImplementedError):
        return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """A run's folder that is not needed any more, on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark removes a query's shuffle files when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries within go as soon as each has ended: for results that are stored or collected."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per context, for functions that run in Python workers."""
    context = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    if context.applicationId in _shipped or not os.path.isdir(package):
        # Done before, or imported from an archive that was submitted with the application.
        return
    parent, name = os.path.split(package)
    # Made on the driver; Spark hands the archive to the executors.
    target = os.path.join(tempfile.mkdtemp(prefix="windrow-"), name)
    context.addPyFile(shutil.make_archive(target, "zip", parent, name))
    _shipped.add(context.applicationId)


_shipped: set[str] = set()
