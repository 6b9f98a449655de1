"""The first flagged delivery of each time, as it arrives (DUP2 on a stream).

Arbitrary keyed state remembers which times have had their delivery; a state
row is evicted after a time to live, so state is bounded by the times of that
span.  A batch's flagged rows are cut to the first of each time inside every
task before they are shuffled, so a time with very many flagged rows sends one
row per Arrow batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import DataType, IntegerType, LongType, TimestampType

#: How long a time is remembered.
TIME_TO_LIVE_MS = 24 * 3600 * 1000


#: Column names inside the stateful step; the row itself is one text, which keeps its types.
_KEY, _ORDER, _ROW, _AT, _MS = "key", "order", "row", "at", "ms"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _first_of_batch(batches: Iterator) -> Iterator:
    """Arrow batches cut to the least row of each key."""
    import pyarrow as pa

    for batch in batches:
        least: dict = {}
        keys, orders = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (key, order) in enumerate(zip(keys, orders)):
            key = "nan" if key != key else key
            if key not in least or order < orders[least[key]]:
                least[key] = i
        yield batch.take(pa.array(sorted(least.values()), pa.int64()))


def _first_only(ttl_ms: int):
    """Per key: the least row of the first batch that has one, and nothing until the state is evicted."""

    def decide(key: tuple, batches: Iterator, state) -> Iterator:
        if state.hasTimedOut:
            state.remove()
            return
        first = None
        for rows in batches:
            at = rows[_ORDER].idxmin()
            if first is None or rows[_ORDER][at] < first[0]:
                first = (rows[_ORDER][at], rows.loc[[at], [_ROW]], int(rows[_MS][at]))
        if not state.exists and first is not None:
            state.update((True,))
            state.setTimeoutTimestamp(max(first[2], state.getCurrentWatermarkMs()) + ttl_ms)
            yield first[1]

    return decide


def first_per_key(rows: DataFrame, key: str, order: Sequence[str], ttl_ms: int = TIME_TO_LIVE_MS, delay: str = "10 minutes") -> DataFrame:
    """Of a stream, the first row of each value of ``key`` (a null is a value), in the order of arrival.

    Rows of one batch are ordered by the ``order`` columns, nulls last; the
    first of them is a timestamp and moves the stream's clock; rows more than
    ``delay`` behind it are left out (arrival times are never behind).  A key is
    forgotten once that clock is ``ttl_ms`` past its row; later rows of it
    count as new.  Write the result in append mode.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # an order text that sorts like the columns: fixed width, nulls last
    parts = [F.when(F.col(c).isNull(), F.lit("z")).otherwise(_sortable(F.col(c), rows.schema[c].dataType)) for c in order]
    packed = rows.select(
        F.col(key).alias(_KEY),
        F.concat_ws("|", *parts).alias(_ORDER),
        F.to_json(F.struct(*rows.columns), _JSON).alias(_ROW),
        F.col(order[0]).alias(_AT),
        F.coalesce(F.unix_millis(order[0]), F.lit(0).cast("long")).alias(_MS),
    )
    fewer = packed.mapInArrow(_first_of_batch, packed.schema).withWatermark(_AT, delay)
    decided = fewer.groupBy(_KEY).applyInPandasWithState(
        _first_only(ttl_ms), f"{_ROW} string", "done boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
    return decided.select(F.from_json(_ROW, rows.schema, _JSON).alias(_ROW)).select(f"{_ROW}.*")


def _sortable(value: Column, kind: DataType) -> Column:
    """A text that sorts like a whole number or a timestamp."""
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value)
    elif not isinstance(kind, (IntegerType, LongType)):
        raise TypeError(f"order columns must be whole numbers or timestamps, not {kind.simpleString()}")
    # as an unsigned number of 20 digits
    return F.lpad((value.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
