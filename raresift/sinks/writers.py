"""Distributed sinks for models, samples, documents and messages (SNK2-SNK5).

Every writer is a Spark write: nothing is assembled in driver memory and
written with Python file calls, so the output lands on whatever file system
the paths name (local, HDFS, object store).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_sample_csv(df: DataFrame, path: str, label: str = "label", prediction: str = "prediction") -> str:
    """Header ``label,prediction`` with integer values (SNK2).

    ``df`` is already bounded (a top-n), so one output file is cheap.
    """
    (
        df.select(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
    return path


def write_document(doc: DataFrame, path: str) -> str:
    """A one-row DataFrame of scalars, structs and arrays as a JSON document (SNK3, SNK4)."""
    doc.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_messages(messages: DataFrame, path: str, mode: str = "append") -> str:
    """One JSON message per line from a ``value`` string column (SNK5)."""
    messages.select("value").write.mode(mode).text(path)
    return path
