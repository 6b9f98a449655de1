"""Packing documents into fixed-length token sequences.

Every document is cut into pieces of at most ``length`` ids.  The pieces are
dealt at random into groups of bounded size, and each group packs its pieces
by first-fit decreasing: a tournament tree over the remaining room of the
bins finds the first bin that takes a piece in logarithmic time.  Groups are
independent tasks, so no task grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.llm._ship import ship
from raresift.llm._text import column, text_bytes, text_slices
from raresift.llm._tokens import encoder
from raresift.operators.persist import materialize

END_ID = 0
GROUP_PIECES = 8192
DEAL_SEED = 20

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; pieces larger than ``capacity`` are an error.

    ``room`` is a complete binary tree whose leaves are the bins in order and
    whose inner nodes hold the most room below, so the walk from the root that
    prefers the left child ends at the first bin with enough room.
    """
    n = len(sizes)
    if n and int(sizes.max()) > capacity:
        raise ValueError("a piece is longer than a sequence")
    leaves = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def token_pieces(
    docs: DataFrame, tokenizer: str, length: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: where it lies in its document, its crc32, and the document's ids.

    A document's ids are those of its whole text and the end id; an empty or
    null text has the end id alone.  No shuffle.
    """

    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 4 << 20):
            ids, offsets = encoder(tokenizer).encode(*text_bytes(column(batch, "text")))
            keys = column(batch, "doc_id").to_pylist()
            rows: list[tuple] = []
            for key, a, b in zip(keys, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                raw = ids[a:b].astype("<u4").tobytes() + END_ID.to_bytes(4, "little")
                total = b - a + 1
                for start in range(0, total, length):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((key, start, len(part) // 4, zlib.crc32(part), total))
                if len(rows) >= 50_000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(cut, PIECE_SCHEMA)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 1024,
    group_pieces: int = GROUP_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``length`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    A sequence's pieces follow each other without gaps from offset 0; what is
    left up to ``length`` is padding.  Null texts count as empty, null or
    repeated ids are packed like any other row (every row has its own
    pieces), an empty table gives no rows, and further columns are left out.
    """
    pieces = materialize(token_pieces(docs, tokenizer, length, id_col, text_col), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    def place(key: tuple, table: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(column(table, "length").to_numpy(), length)
        sequence = (key[0].as_py() << 32) + bins
        return (
            table.drop_columns(["pack"])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    dealt = pieces.withColumn("pack", F.floor(F.rand(DEAL_SEED) * groups).cast("long"))
    return dealt.groupBy("pack").applyInArrow(place, PACKED_SCHEMA)
