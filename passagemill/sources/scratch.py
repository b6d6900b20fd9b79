"""Where intermediate tables go: the shared folder that the cluster names, and how long they stay."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session may fall back to /tmp."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class Scope:
    """Intermediate tables of one job."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[str] = []

    def own(self, path: str) -> None:
        self._paths.append(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this job that no later step reads."""
        for table in tables:
            path = getattr(table, _PATH, None)
            if path in self._paths:
                self._paths.remove(path)
                _delete(self._spark, path)

    def close(self) -> None:
        for path in self._paths:
            _delete(self._spark, path)
        self._paths = []


_PATH = "_scratch_path"
_scope: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def job_scope(spark: SparkSession) -> Iterator[Scope]:
    """Tables that :func:`stored` writes inside are deleted at the end, also when the job fails.

    Tables stored with ``keep`` stay: those that the job returns or returned tables read. Scopes
    nest; a table belongs to the innermost one.
    """
    scope = Scope(spark)
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        scope.close()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends at the files, columns stay prunable.

    An open :func:`job_scope` owns the table unless ``keep``.
    """
    path = scratch_path(df.sparkSession, label)
    scope = _scope.get()
    if scope and not keep:
        scope.own(path)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(table, _PATH, path)
    return table
