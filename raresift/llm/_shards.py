"""Shards of documents that several passes read, and the exchange of sketches between them.

``ShardStore.write`` deals documents by a hash of their id into parts and
writes each part as rows of at most about ``SHARD_BYTES`` of text, bucketed by
part.  Later passes join what other shards answered to a shard's row by (part,
shard): the table is bucketed, so texts are shuffled once, however many passes
follow.

``exchange`` brings equal 64-bit keys of all shards together.  A shard sends
each key once, whatever number of times it holds it, packed into one binary
for each bucket of keys; so a passage that a third of all documents share
costs one key a shard, and no task gets a hot key's rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raresift.llm._ship import ship
from raresift.llm._text import column, text_bytes, text_slices
from raresift.operators.persist import discard
from raresift.session import scratch_path

SHARD_BYTES = 1 << 20
PART_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
LEAST_PARTS, MOST_PARTS = 16, 50_000

SHARD_SCHEMA = "part int, shard long, n_bytes long, data binary, offsets binary, rows binary"
MESSAGE_SCHEMA = "bucket int, part int, shard long, payload binary"
ANSWER_SCHEMA = "part int, shard long, payload binary"


@dataclass
class ShardRow:
    """One shard in a task."""

    part: int
    shard: int
    data: np.ndarray
    offsets: np.ndarray
    rows: bytes
    answers: list[bytes]
    own: bytes | None
    more: dict[str, pa.Scalar]

    def others(self) -> pa.RecordBatch:
        """The documents' other columns, and at last whether the text is null."""
        with pa.ipc.open_stream(pa.py_buffer(self.rows)) as reader:
            return reader.read_all().combine_chunks().to_batches()[0]


_PLAIN = {"part", "shard", "n_bytes", "data", "offsets", "rows", "answers", "own"}


def shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[ShardRow]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            yield ShardRow(
                row["part"].as_py(),
                row["shard"].as_py(),
                np.frombuffer(row["data"].as_buffer() or b"", np.uint8),
                np.frombuffer(row["offsets"].as_buffer(), np.int64),
                row["rows"].as_py(),
                (row["answers"].as_py() or []) if "answers" in row else [],
                row["own"].as_py() if "own" in row else None,
                {k: v for k, v in row.items() if k not in _PLAIN and v.is_valid},
            )


class ShardStore:
    """A written table of shards; ``drop`` deletes it."""

    def __init__(self, spark: SparkSession, name: str, parts: int, total_bytes: int, others: pa.Schema):
        self.spark, self.name, self.parts, self.total_bytes, self.others = spark, name, parts, total_bytes, others

    @staticmethod
    def write(docs: DataFrame, order_col: str, text_col: str = "text", part_bytes: int = PART_BYTES) -> ShardStore:
        """Shards of all rows of ``docs``; within a shard they are in the order of ``order_col`` (a long)."""
        spark = ship(docs.sparkSession)
        sized = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
        parts = int(min(MOST_PARTS, max(LEAST_PARTS, -(-sized // part_bytes))))
        part_col = unused("__part", docs.columns)
        dealt = docs.withColumn(part_col, F.pmod(F.xxhash64(F.col(order_col)), F.lit(parts)).cast("int"))
        ordered = dealt.repartition(parts, part_col).sortWithinPartitions(part_col, order_col, F.xxhash64(text_col))
        names = [c for c in docs.columns if c != text_col]

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            serial = TaskContext.get().partitionId() << 32
            held: list[pa.RecordBatch] = []
            held_part, held_bytes = -1, 0
            for batch in _by_part(text_slices(batches, text_col, SHARD_BYTES // 4), part_col):
                part = column(batch, part_col)[0].as_py()
                size = len(text_bytes(column(batch, text_col))[0])
                if held and (part != held_part or held_bytes + size > SHARD_BYTES):
                    yield _folded(held, held_part, serial, names, text_col)
                    serial += 1
                    held, held_bytes = [], 0
                held.append(batch)
                held_part, held_bytes = part, held_bytes + size
            if held:
                yield _folded(held, held_part, serial, names, text_col)

        name = f"raresift_shards_{uuid.uuid4().hex[:12]}"
        (
            ordered.mapInArrow(fold, SHARD_SCHEMA)
            .write.bucketBy(parts, "part")
            .option("path", scratch_path(spark, "shards"))
            .option("compression", "zstd")
            .format("parquet")
            .saveAsTable(name)
        )
        empty = docs.select(*names).limit(0).toArrow().schema
        return ShardStore(spark, name, parts, int(sized), empty)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def answered(self, answers: DataFrame | None = None, own: DataFrame | None = None, **by_part: DataFrame) -> DataFrame:
        """Shards with what belongs to them, null for nothing.

        ``answers``: their payloads as an array; ``own``: what they left for
        themselves; ``by_part``: further columns, each from a table (part,
        value) with one row for each part.
        """
        out = self.read()
        if answers is not None:
            mine = answers.groupBy("part", "shard").agg(F.collect_list("payload").alias("answers"))
            out = out.join(mine.hint("shuffle_hash"), ["part", "shard"], "left")
        if own is not None:
            left = own.filter(F.col("bucket") == OWN).select("part", "shard", F.col("payload").alias("own"))
            out = out.join(left.hint("shuffle_hash"), ["part", "shard"], "left")
        for name, table in by_part.items():
            mine = table.select("part", F.col("value").alias(name))
            out = out.join(mine.hint("shuffle_hash"), "part", "left")
        return out

    def part_of(self, order_col: str) -> Column:
        """The part of a document with this id."""
        return F.pmod(F.xxhash64(F.col(order_col)), F.lit(self.parts)).cast("int")

    @contextmanager
    def joins(self) -> Iterator[None]:
        """While inside, rows bucketed by part alone may be joined by (part, shard) where they lie."""
        key = "spark.sql.requireAllClusterKeysForCoPartition"
        before = self.spark.conf.get(key, "true")
        self.spark.conf.set(key, "false")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def drop(self, *tables: DataFrame) -> None:
        """Delete the shards, and tables written on the way to a result that is written itself."""
        for table in (self.read(), *tables):
            discard(table)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def buckets(self, bytes_per_text_byte: float) -> int:
        """How many buckets keep one near BUCKET_BYTES, for keys of this much a byte of text."""
        return max(1, int(self.total_bytes * bytes_per_text_byte) // BUCKET_BYTES)


def unused(name: str, taken: Iterable[str]) -> str:
    """A column name like ``name`` that is none of ``taken``, whatever their case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def _by_part(batches: Iterator[pa.RecordBatch], part_col: str) -> Iterator[pa.RecordBatch]:
    """Batches cut where the part changes."""
    for batch in batches:
        parts = column(batch, part_col).to_numpy()
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _folded(held: list[pa.RecordBatch], part: int, shard: int, names: list[str], text_col: str) -> pa.RecordBatch:
    whole = pa.Table.from_batches(held).combine_chunks()
    data, offsets = text_bytes(column(whole, text_col))
    others = whole.select(names)
    nulls = column(whole, text_col).is_null()
    others = others.append_column(unused("__null", names), nulls)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, others.schema) as writer:
        writer.write_table(others)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([shard], pa.int64()),
            pa.array([len(data)], pa.int64()),
            pa.array([data.tobytes()], pa.binary()),
            pa.array([np.ascontiguousarray(offsets, np.int64).tobytes()], pa.binary()),
            pa.array([sink.getvalue().to_pybytes()], pa.binary()),
        ],
        ["part", "shard", "n_bytes", "data", "offsets", "rows"],
    )


def message(row: ShardRow, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """A shard's keys (ascending, mixed) and the values beside them, one row per bucket of keys.

    Also returns where each bucket's records begin, with the end at last.
    """
    bounds = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets) << np.uint64(32)
    cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]]).astype(np.int64)
    which = np.flatnonzero(np.diff(cuts))
    payloads = [
        b"".join([keys[a:b].tobytes(), *(v[a:b].tobytes() for v in values)])
        for a, b in zip(cuts[which].tolist(), cuts[which + 1].tolist(), strict=True)
    ]
    return messages(row, which, payloads), cuts


def messages(row: ShardRow, buckets: np.ndarray, payloads: list[bytes]) -> pa.RecordBatch:
    n = len(payloads)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(buckets, pa.int32()),
            pa.array(np.full(n, row.part), pa.int32()),
            pa.array(np.full(n, row.shard), pa.int64()),
            pa.array(payloads, pa.binary()),
        ],
        ["bucket", "part", "shard", "payload"],
    )


#: The bucket of what a shard leaves for its own next pass.
OWN = -1


def unpack(payload: bytes, kinds: list[str]) -> list[np.ndarray]:
    """The arrays of a payload of records of these kinds (numpy type names), kind after kind."""
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(payload) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(payload, kind, n, at))
        at += n * size
    return out


def exchange(sent: DataFrame, resolve: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """Answers to the shards' messages.

    ``resolve`` gets the payloads of one bucket in the order of their shards
    and returns an answer for each (empty for none).  An answer begins with
    its bucket as eight bytes.
    """

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        found = resolve([p.as_buffer().to_pybytes() for p in column(table, "payload")])
        picked = pa.array([i for i, x in enumerate(found) if x], pa.int64())
        head = int(key[0].as_py()).to_bytes(8, "little")
        return pa.table(
            {
                "part": column(table, "part").take(picked),
                "shard": column(table, "shard").take(picked),
                "payload": pa.array([head + x for x in found if x], pa.binary()),
            }
        )

    return sent.filter(F.col("bucket") != OWN).groupBy("bucket").applyInArrow(answer, ANSWER_SCHEMA)


def merged(payloads: list[bytes], kinds: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(sender, arrays) of all senders' sorted records, merged by their first array."""
    parts = [unpack(p, kinds) for p in payloads]
    sender = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    arrays = [np.concatenate(x) for x in zip(*parts, strict=True)]
    by = np.argsort(arrays[0], kind="stable")
    return sender[by], [a[by] for a in arrays]


def to_senders(sender: np.ndarray, senders: int, answers: list[np.ndarray]) -> list[bytes]:
    """Each sender's records of the answer, kind after kind, in the order of the keys."""
    by = np.argsort(sender, kind="stable")
    cuts = np.searchsorted(sender[by], np.arange(senders + 1)).tolist()
    answers = [a[by] for a in answers]
    return [b"".join(x[a:b].tobytes() for x in answers) for a, b in zip(cuts, cuts[1:])]


def repeated_keys(payloads: list[bytes]) -> list[bytes]:
    """Of records (key, whether the sender holds it twice): to each sender, its keys that are there twice."""
    sender, (key, twice) = merged(payloads, ["<u8", "u1"])
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    many = np.diff(np.append(begins, len(key)))
    hit = np.repeat((many > 1) | np.maximum.reduceat(twice, begins).astype(bool), many)
    return to_senders(sender[hit], len(payloads), [key[hit]])


def answered_keys(answers: list[bytes]) -> np.ndarray:
    """All keys that ``repeated_keys`` sent, ascending."""
    return np.sort(np.concatenate([np.frombuffer(a, "<u8", offset=8) for a in answers] or [np.zeros(0, np.uint64)]))


def within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Mask of the values found in ``known`` (sorted)."""
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of a mask."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]
