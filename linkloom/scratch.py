"""Shared scratch space: where lineage is cut and intermediate tables are written."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scope: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch_scope", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A local session that names none gets a fresh folder of its own; a cluster
    must name one, because a machine-local folder is invisible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="linkloom-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_scope.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[None]:
    """Intermediate tables written inside the block are deleted after it.

    For work that has written its results elsewhere by then, such as one micro-batch of a
    stream that runs for long.
    """
    path = scratch_path(spark, label)
    token = _scope.set(path)
    try:
        yield
    finally:
        _scope.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage (scratch tables, partitions), if it exists."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors,
    and lets every later reader prune columns. ``compression``: the session's, if none is named."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
