"""Durable intermediate tables.

A plan whose intermediate result is read several times, or whose row numbering
must not be recomputed differently after an executor is lost, writes it as a
table in the shared folder named by ``spark.checkpoint.dir``.
"""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_scope: ContextVar[str] = ContextVar("scratch_scope", default="")


def durable_root(spark: SparkSession) -> str:
    """Shared folder of the cluster; a temporary one only in local mode."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="clickmart-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def _scratch_root(spark: SparkSession) -> str:
    return f"{durable_root(spark)}/clickmart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the durable folder of this application."""
    return f"{_scratch_root(spark)}{_scope.get()}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed at the end.

    Nothing that reads them lazily may leave the scope.
    """
    token = _scope.set(f"{_scope.get()}/scope-{uuid.uuid4().hex}")
    folder = _scratch_root(spark) + _scope.get()
    try:
        yield
    finally:
        _scope.reset(token)
        remove_path(spark, folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a path through the file system Spark uses for it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; empty when it does not exist."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))
