"""Materialising intermediate tables (CCH1).

The training job reuses its cleaned table many times.  Caching alone keeps
a long lineage (CSV scan + distinct shuffle) that must be recomputed when an
executor holding cached blocks is lost; writing the table as parquet under
the shared ``spark.checkpoint.dir`` cuts that lineage and keeps column
pruning and statistics for every later scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from raresift.session import scratch_path


class Scratch:
    """The tables written inside a ``scratch_scope``."""

    def __init__(self):
        self.paths: list[str] = []

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """``df`` written once more, to outlive the scope; its reader may come as late as it likes."""
        spark = df.sparkSession
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


_SCOPE: ContextVar[Scratch | None] = ContextVar("raresift_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Owns every table that ``materialize`` writes inside it, and deletes them at its end, after an error too.

    What leaves the scope must go through ``result``.  Scopes nest: a table
    belongs to the innermost one.  A write that failed half way leaves no files either.
    """
    scope = Scratch()
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            _delete(spark, path)


def materialize(df: DataFrame, name: str = "table", options: dict[str, int] | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, with the writer's ``options``, and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (scope := _SCOPE.get()) is not None:
        scope.paths.append(path)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Memory-and-disk persistence for short-lived reuse (recomputable on loss)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised table (the folders that ``df`` reads)."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        _delete(spark, spark.sparkContext._jvm.java.net.URI(folder))


def _delete(spark: SparkSession, folder) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
