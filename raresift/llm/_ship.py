"""Making the package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import raresift

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once per application.

    Spark sends the archive to every executor, so tasks can import the
    package wherever the driver found it.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(raresift.__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="raresift-py-"), "raresift-py.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(root)))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark
