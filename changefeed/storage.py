"""Where intermediate tables live: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_local_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; a temporary one only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="changefeed-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/changefeed/{label}-{uuid.uuid4().hex}"


def materialise_counted(df: DataFrame, label: str, which: Column | None = None) -> tuple[DataFrame, int]:
    """:func:`materialise`, and the number of rows (for which a condition holds), counted by the same job."""
    seen = Observation()
    counted = F.lit(1) if which is None else F.when(which, 1)
    written = materialise(df.observe(seen, F.count(counted).alias("rows")), label)
    return written, seen.get["rows"]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that it survives lost executors, pins values that a
    second evaluation could change, and gives the optimizer the real size, so
    Spark itself decides between a broadcast and a shuffle join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session option while one job is planned and run."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, on the file system that Spark takes it to be on."""
    system = _file_system(spark, path)
    return _path(spark, path).makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    statuses = _file_system(spark, path).listStatus(_path(spark, path))
    if not len(statuses):
        return []
    # One text of all paths, each below the same parent: a call for each takes long for many.
    jvm = spark.sparkContext._jvm
    parent = statuses[0].getPath().getParent().toString().rstrip("/") + "/"
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses))
    return text[1 + len(parent) : -1].split(f",{parent}")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern))
    return [status.getPath().toString() for status in found or []]


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    _file_system(spark, path).create(_path(spark, path)).close()


def delete_dir(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).delete(_path(spark, path), True)
