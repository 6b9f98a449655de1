"""Whether a sink holds every delivery exactly once (STR6).

After cuts, crashes and restarts the sink is compared with its source: each
delivery is known by where it came from and what it was, so a batch that was
lost or written twice shows as missing or repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.operators.events import ID, decode_messages
from raresift.streaming.scorer import SOURCE_FILE

COUNTS = ("deliveries", "stored")
#: Rows of both sides that one task counts, about.
TASK_ROWS = 250_000


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with equal keys of a batch as one, with their counts added."""
    for batch in batches:
        key = [c for c in batch.schema.names if c not in COUNTS]
        sums = pa.Table.from_batches([batch]).group_by(key).aggregate([(c, "sum") for c in COUNTS])
        yield from sums.rename_columns({f"{c}_sum": c for c in COUNTS}).select(batch.schema.names).to_batches()


def audit_deliveries(messages: DataFrame, sink: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Per kind: deliveries, stored, missing and repeated rows.

    ``messages`` is the source read as a batch (``value`` and
    ``source_file``).  Both sides are counted by (origin, id, kind, reason).
    Most of these keys occur once, so a task that combined all its rows before
    the shuffle would hold nearly all of them: they are combined by batch only,
    which shrinks a delivery repeated a million times as well, and dealt to as
    many tasks as the rows need.
    """
    key = [SOURCE_FILE, ID, "kind", "reason"]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    there = decode_messages(messages, feature_cols, keep=[SOURCE_FILE]).select(*key, one.alias("deliveries"), none.alias("stored"))
    here = sink.select(*key, none.alias("deliveries"), one.alias("stored"))
    rows = there.unionByName(here)
    tasks = max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-(messages.count() + sink.count()) // TASK_ROWS)
    )
    types = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    both = (
        rows.mapInArrow(_combined, types)
        .repartition(tasks, *key)
        .groupBy(*key)
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    )
    return both.groupBy("kind").agg(
        F.sum("deliveries").alias("deliveries"),
        F.sum("stored").alias("stored"),
        F.sum(F.greatest(F.col("deliveries") - F.col("stored"), F.lit(0))).alias("missing"),
        F.sum(F.greatest(F.col("stored") - F.col("deliveries"), F.lit(0))).alias("repeated"),
    )
