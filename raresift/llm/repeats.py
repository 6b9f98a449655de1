"""Substring deduplication by level-wise doubling of word windows.

Windows of a quarter of the full length come first, then half, then the full
length.  Within a full window the smallest hash of its shorter windows stands
for it, so equal full windows have equal keys at every level and a level
exchanges only the few windows that are smallest somewhere.  Only full
windows whose key was repeated at one length are extended to the next;
those that are repeated at full length are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.llm._shards import (
    MESSAGE_SCHEMA, ShardRow, ShardStore, answered_keys, exchange, message, repeated_keys, shard_rows, within,
)
from raresift.llm._text import SPACED, Windows, covered, find_words, hash_words, mix, slide, window_starts
from raresift.operators.persist import materialize

WINDOW = 35
#: Levels stop halving at this many words.
SHORTEST = 10

RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string"


def levels(window: int) -> list[int]:
    """Window lengths of the levels, ascending: the full length, halved while it is over SHORTEST."""
    out = [window]
    while out[-1] > SHORTEST:
        out.append(-(-out[-1] // 2))
    return out[::-1]


class ShardWords:
    """The words of a shard and the keys of its full windows."""

    def __init__(self, row: ShardRow, window: int):
        self.starts, self.ends, self.first = find_words(row.data, row.offsets, SPACED)
        self.windows = Windows(hash_words(row.data, self.starts, self.ends))
        self.window = window
        #: Starts of full windows.
        self.at = np.flatnonzero(window_starts(self.first, window))

    def keys(self, length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys of the full windows at ``at``, hashes of all windows of ``length`` words)."""
        hashes = self.windows.of(length)
        return (slide(hashes, self.window - length + 1, np.minimum)[at] if len(at) else np.zeros(0, np.uint64)), hashes


def _candidates(row: ShardRow, window: int, length: int | None) -> tuple[ShardWords, np.ndarray]:
    """The full windows whose key of ``length`` words was answered; all of them before the first level."""
    words = ShardWords(row, window)
    if length is None:
        return words, words.at
    keys, _ = words.keys(length, words.at)
    return words, words.at[within(mix(keys), answered_keys(row.answers))]


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and kept_text (kept words joined by one space).

    Every word covered by a window of ``window`` words whose sequence also
    starts anywhere else, in the same document or another, is removed;
    windows are judged on the input.  Null and empty texts have no words,
    shorter texts lose none.  Every row is a document of its own, so repeated
    rows lose all their windows; null ids are allowed, and columns beyond the
    two are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    store = ShardStore.write(rows, "doc_id")
    answers, before, written = None, None, []
    with store.joins():
        for length in levels(window):
            # windows of a length that are smallest in some full window: two of as many as it has, plus one
            dense = 2 / (window - length + 2) if length < window else 0.3
            buckets = store.buckets(9 * dense / 6)
            shards = store.read() if answers is None else store.answered(answers)
            sent = shards.mapInArrow(_level(window, length, before, buckets), MESSAGE_SCHEMA)
            answers = exchange(sent, repeated_keys)
            if length < window:
                answers, before = materialize(answers, f"repeats-{length}"), length
                written.append(answers)
        result = materialize(store.answered(answers).mapInArrow(_cut(window), RESULT_SCHEMA), "repeats")
    store.drop(*written)
    return result


def _level(window: int, length: int, before: int | None, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            words, at = _candidates(row, window, before)
            keys, hashes = words.keys(length, at)
            keys, many = np.unique(keys, return_counts=True)
            if length < window:
                every = np.sort(hashes)
                many = np.searchsorted(every, keys, side="right") - np.searchsorted(every, keys)
            keys = mix(keys)
            by = np.argsort(keys)
            yield message(row, keys[by], [(many[by] > 1).astype(np.uint8)], buckets)[0]

    return send


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in shard_rows(batches):
            words, at = _candidates(row, window, window)
            gone = covered(at, window, len(words.starts))
            first = words.first
            n_words = np.diff(first)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            # bytes of kept words, each but a document's first after one space
            keep = np.flatnonzero(~gone)
            doc = np.searchsorted(first, keep, side="right") - 1
            size = words.ends[keep] - words.starts[keep]
            lead = np.ones(len(keep), np.int64)
            lead[np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))[: len(keep)]] = 0
            to = np.cumsum(size + lead)
            text = np.full(int(to[-1]) if len(to) else 0, 0x20, np.uint8)
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            text[np.repeat(to - size, size) + step] = row.data[np.repeat(words.starts[keep], size) + step]
            bounds = np.concatenate([[0], np.bincount(doc, weights=size + lead, minlength=len(n_words)).cumsum()])
            kept = pa.Array.from_buffers(
                pa.large_string(), len(n_words),
                [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())],
            )
            others = row.others()
            yield pa.RecordBatch.from_arrays(
                [
                    others.column(others.schema.get_field_index("doc_id")),
                    pa.array(n_words, pa.int64()),
                    pa.array(removed, pa.int64()),
                    kept.cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return cut
